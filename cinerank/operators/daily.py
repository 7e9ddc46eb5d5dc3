"""Dataset summary from mergeable sketches, one row per day: later days are merged in without reading earlier ratings.

Distinct users and movies are HyperLogLog sketches (relative standard error about 1.04 / sqrt(2^lg_k), 1.6 % at 12), the median a KLL sketch (rank error
about 1.3 % at k = 200). A day's row has a fixed size, so a summary reads days x a few kilobytes whatever the number of ratings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import encoders as E


def daily_sketches(ratings: DataFrame, lg_k: int = 12, period: str | None = None) -> DataFrame:
    """(day, n, rating_sum, rated, users, movies, ratings, first_ts, last_ts) per day, or per ``period`` ("month", "year"; day is its first);
    ratings without a time have a null day."""
    day = E.epoch_to_date("ts")
    return ratings.groupBy((F.trunc(day, period) if period else day).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("rating").cast("decimal(20,6)")).alias("rating_sum"), F.count("rating").alias("rated"),
        F.hll_sketch_agg("user_id", F.lit(lg_k)).alias("users"), F.hll_sketch_agg("movie_id", F.lit(lg_k)).alias("movies"),
        F.kll_sketch_agg_double(F.col("rating").cast("double")).alias("ratings"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def add_days(path: str, ratings: DataFrame, lg_k: int = 12, period: str | None = None) -> None:
    """Writes the rows of the days (periods) in ``ratings``, which are whole, to the table in ``path``; those are replaced, others not touched or read."""
    (daily_sketches(ratings, lg_k, period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sketched_summary(days: DataFrame) -> DataFrame:
    """As ``dataset_summary``, from daily rows: counts, mean and dates exact, distinct counts and median within the sketches' errors."""
    return days.agg(
        F.sum("n").alias("n_ratings"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("n_users"),
        F.hll_sketch_estimate(F.hll_union_agg("movies")).alias("n_movies"),
        F.round((F.sum("rating_sum") / F.sum("rated")).cast("double"), 6).alias("rating_mean"),
        F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("ratings"), F.lit(0.5)).alias("rating_median"),
        E.epoch_to_date(F.min("first_ts")).alias("first_date"), E.epoch_to_date(F.max("last_ts")).alias("last_date"))
