"""Descriptive analytics over ratings / users / movies: summaries, distributions,
group-size statistics, leaderboards, genre and demographic counts, monthly series.

All are plain group-bys with map-side partial aggregation, so a hot key (one
user or movie holding a large share of the ratings) is combined inside each
map task before the shuffle and never lands as raw rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import encoders as E
from ..session import cut_lineage
from .quantiles import exact_quantiles


def table_counts(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """Row count per table, one row each."""
    def cnt(df, name):
        return df.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
            F.lit(name).alias("table_name"), "n")
    return cnt(ratings, "ratings").unionByName(cnt(users, "users")).unionByName(cnt(movies, "movies"))


def dataset_summary(ratings: DataFrame, approx: bool = False) -> DataFrame:
    """Rows, distinct users and movies, mean and median rating, first and last day."""
    if approx:
        n_users = F.approx_count_distinct("user_id")
        n_movies = F.approx_count_distinct("movie_id")
        median = F.percentile_approx(F.col("rating").cast("double"), 0.5)
    else:
        n_users = F.count_distinct("user_id")
        n_movies = F.count_distinct("movie_id")
        found = exact_quantiles(ratings, F.col("rating").cast("double"), [0.5])
        median = F.lit(float(found[0][0]) if found else None)
    return ratings.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_ratings"),
        n_users.cast("bigint").alias("n_users"),
        n_movies.cast("bigint").alias("n_movies"),
        F.round(F.avg(F.col("rating").cast("double")), 6).alias("rating_mean"),
        median.cast("double").alias("rating_median"),
        E.epoch_to_date(F.min("ts")).alias("first_date"),
        E.epoch_to_date(F.max("ts")).alias("last_date"),
    )


def rating_distribution(ratings: DataFrame) -> DataFrame:
    return (ratings.groupBy(F.col("rating").cast("double").alias("rating"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
            .orderBy("rating"))


def activity(ratings: DataFrame, key: str) -> DataFrame:
    """Ratings per ``key`` (user_id or movie_id)."""
    return ratings.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("n_ratings"))


def activity_per_user(ratings: DataFrame) -> DataFrame:
    return activity(ratings, "user_id")


def activity_per_movie(ratings: DataFrame) -> DataFrame:
    return activity(ratings, "movie_id")


def _entity_sizes(ratings: DataFrame) -> DataFrame:
    """(entity, n) with one row per user and per movie: both group-size columns."""
    u = activity(ratings, "user_id").select(F.lit("user").alias("entity"), F.col("n_ratings").alias("n"))
    m = activity(ratings, "movie_id").select(F.lit("movie").alias("entity"), F.col("n_ratings").alias("n"))
    return u.unionByName(m)


def describe_counts(ratings: DataFrame) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max of the
    number of ratings per user and per movie. Quartiles are selected by counting over narrowing ranges: no task holds the sizes."""
    sizes = cut_lineage(_entity_sizes(ratings))
    found = exact_quantiles(sizes, F.col("n"), [0.25, 0.5, 0.75], F.col("entity"))
    q = F.lit(None).cast("array<double>")
    for entity, values in found.items():
        q = F.when(F.col("entity") == entity, F.array(*[F.lit(float(v)) for v in values])).otherwise(q)
    out = (sizes.groupBy("entity").agg(
        F.count(F.lit(1)).cast("bigint").alias("count"),
        F.round(F.avg("n"), 6).alias("mean"),
        F.round(F.stddev_samp("n"), 6).alias("std"),
        F.min("n").cast("double").alias("min"),
        F.max("n").cast("double").alias("max"),
    )).withColumn("q", q)
    return out.select(
        "entity", "count", "mean", "std", "min",
        F.round(F.col("q")[0], 6).alias("p25"),
        F.round(F.col("q")[1], 6).alias("p50"),
        F.round(F.col("q")[2], 6).alias("p75"),
        "max",
    )


def activity_histogram(ratings: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width histogram of group sizes (users and movies), empty bins as 0.

    Bin i (1-based) covers [lo + (i-1)w, lo + i w); the last bin is closed. When
    all sizes are equal the range is widened by 0.5 on both sides.
    """
    # How often each size occurs: computed once, as many rows as there are different sizes.
    sizes = cut_lineage(_entity_sizes(ratings).groupBy("entity", "n").agg(F.count(F.lit(1)).alias("times")))
    rng = sizes.groupBy("entity").agg(F.min("n").alias("mn"), F.max("n").alias("mx")).select(
        "entity",
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn").cast("double")).alias("lo"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx").cast("double")).alias("hi"),
    )
    # rng has one row per entity kind (2 rows): a proven-small broadcast side.
    idx = F.floor((F.col("n").cast("double") - F.col("lo")) * F.lit(float(bins)) / (F.col("hi") - F.col("lo")))
    counted = (sizes.join(F.broadcast(rng), "entity")
               .groupBy("entity", (F.least(idx, F.lit(bins - 1)) + 1).cast("int").alias("bin"))
               .agg(F.sum("times").cast("bigint").alias("n")))
    grid = rng.select("entity", "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (grid.join(counted, ["entity", "bin"], "left")
            .select("entity", "bin",
                    F.round(F.col("lo") + (F.col("bin") - 1) * width, 6).alias("bin_lo"),
                    F.round(F.col("lo") + F.col("bin") * width, 6).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def movie_stats(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Count and mean rating per rated movie, with its title and genres (left join)."""
    stats = ratings.groupBy("movie_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("rating_count"),
        F.avg(F.col("rating").cast("double")).alias("mean_rating"),
    )
    return stats.join(movies.select("movie_id", "title", "genres"), "movie_id", "left")


def _finish_stats(df: DataFrame) -> DataFrame:
    return df.select("movie_id", "title", "genres", "rating_count",
                     F.round("mean_rating", 6).alias("mean_rating"))


def movie_stats_report(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    return _finish_stats(movie_stats(ratings, movies))


def most_rated(ratings: DataFrame, movies: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` movies with the most ratings (ties by movie_id).

    The top-k runs on the aggregated stats before the title join, so only ``n``
    rows meet the catalogue (safe: left join on a unique key).
    """
    stats = ratings.groupBy("movie_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("rating_count"),
        F.avg(F.col("rating").cast("double")).alias("mean_rating"))
    top = stats.orderBy(F.desc("rating_count"), F.asc("movie_id")).limit(n)
    return _finish_stats(top.join(movies.select("movie_id", "title", "genres"), "movie_id", "left"))


def highest_rated(ratings: DataFrame, movies: DataFrame, n: int = 15, min_ratings: int = 200) -> DataFrame:
    """Movies with at least ``min_ratings`` ratings, by mean then count, both descending."""
    stats = ratings.groupBy("movie_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("rating_count"),
        F.avg(F.col("rating").cast("double")).alias("mean_rating"))
    top = (stats.filter(F.col("rating_count") >= min_ratings)
           .orderBy(F.desc("mean_rating"), F.desc("rating_count"), F.asc("movie_id")).limit(n))
    return _finish_stats(top.join(movies.select("movie_id", "title", "genres"), "movie_id", "left"))


def genre_counts(movies: DataFrame) -> DataFrame:
    """Movies per raw genre name (split on pipe, no strip, repeats counted, empty dropped)."""
    g = movies.select(F.explode(E.split_pipe("genres")).alias("genre"))
    return (g.filter(F.col("genre").isNotNull() & (F.col("genre") != ""))
            .groupBy("genre").agg(F.count(F.lit(1)).cast("bigint").alias("movie_count"))
            .orderBy(F.desc("movie_count"), "genre"))


def users_by_age(users: DataFrame, fill: int | None = None) -> DataFrame:
    """Users per age label, all seven labels in index order; absent labels give
    null (or ``fill``)."""
    counts = (users.filter(E.is_known_age("age"))
              .groupBy(E.age_idx("age").alias("age_idx"))
              .agg(F.count(F.lit(1)).cast("bigint").alias("n_users")))
    dim = schema.dim_age(users.sparkSession).select(F.col("idx").alias("age_idx"), F.col("label").alias("age_label"))
    out = dim.join(counts, "age_idx", "left")
    n = F.col("n_users") if fill is None else F.coalesce("n_users", F.lit(fill)).cast("bigint")
    return out.select("age_idx", "age_label", n.alias("n_users")).orderBy("age_idx")


def top_occupations(users: DataFrame, n: int = 12) -> DataFrame:
    """The ``n`` largest occupation groups (ties by code), listed ascending."""
    counts = (users.select("occupation", E.occupation_label("occupation").alias("occupation_label"))
              .filter(F.col("occupation_label").isNotNull())
              .groupBy("occupation", "occupation_label")
              .agg(F.count(F.lit(1)).cast("bigint").alias("n_users")))
    top = counts.orderBy(F.desc("n_users"), F.asc("occupation")).limit(n)
    return top.orderBy(F.asc("n_users"), F.desc("occupation"))


def users_labelled(users: DataFrame) -> DataFrame:
    """Users with age and occupation labels (null when the code is unmapped)."""
    return users.select("user_id", "gender", E.age_label("age").alias("age_label"),
                        E.occupation_label("occupation").alias("occupation_label"), "zip")


def monthly_ratings(ratings: DataFrame) -> DataFrame:
    """Ratings per calendar month labelled by month end; months without ratings give 0."""
    by_month = (ratings.filter(F.col("ts").isNotNull()).groupBy(E.month_end(E.epoch_to_date("ts")).alias("month_end"))
                .agg(F.count(F.lit(1)).cast("bigint").alias("n_ratings")))
    bounds = by_month.agg(F.min("month_end").alias("lo"), F.max("month_end").alias("hi"))
    months = bounds.select(F.explode(F.sequence(F.trunc("lo", "MM"), F.trunc("hi", "MM"),
                                                F.expr("interval 1 month"))).alias("m")).select(F.last_day("m").alias("month_end"))
    # months: one row per calendar month in the data's span (bounded by the calendar).
    return (months.join(by_month, "month_end", "left")
            .select("month_end", F.coalesce("n_ratings", F.lit(0)).cast("bigint").alias("n_ratings"))
            .orderBy("month_end"))
