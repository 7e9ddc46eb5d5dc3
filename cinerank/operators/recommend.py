"""Cold-start recommendation for a table (or stream) of request profiles.

Plan, built for many requests against a large catalogue:

1. ``validate_requests`` tags each request with the first failing rule (one bad
   request never fails the batch).
2. Genre sets instead of movies: the model sees only genres on the movie side,
   so every movie with the same genre set (``genre_mask``) gets the same score,
   and ties go to the smaller movie_id. Hence only the ``MAX_TOP_N`` smallest
   movie ids of each genre set can ever reach a top-N list.
3. Profiles instead of requests: an answer depends on the four profile indices and the
   request's genre mask only. Distinct (profile, mask) are answered once, so the work is
   bounded by the vocabularies and doesn't grow with the requests.
4. Genre sets are ranked per (profile, mask) and the best 50 kept before movies are joined;
   50 movies are ranked; requests meet their list in one last join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions import encoders as E
from ..model.score import Model, score_arrow

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("occupation", T.IntegerType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("genres", T.ArrayType(T.StringType())),
    T.StructField("top_n", T.IntegerType()),
])

# Reject reasons, in the order the rules are checked.
REJECT_REASONS = ["occupation_range", "genre_count", "top_n_range", "gender_unknown",
                  "age_unknown", "zip_missing", "genre_unknown"]


def request_genres(requests: DataFrame, col: str = "genres") -> F.Column:
    """The genre list of a request, names as given: a list of strings, or a pipe string. Null, '' and [] are the empty list."""
    g, none = F.col(col), F.array().cast("array<string>")
    if isinstance(requests.schema[col].dataType, T.ArrayType):
        return F.coalesce(g, none)
    return F.when(g.isNull() | (g == ""), none).otherwise(E.split_pipe(g))


def validate_requests(requests: DataFrame) -> DataFrame:
    """Requests with ``genre_list``, effective ``top_n`` (default 10), the first
    failing rule as ``reject_reason`` (null when valid) and ``unknown_genres``."""
    known = F.array(*[F.lit(g) for g in schema.GENRES])
    df = requests.withColumn("genre_list", request_genres(requests)) \
                 .withColumn("top_n", F.coalesce(F.col("top_n"), F.lit(schema.DEFAULT_TOP_N)))
    unknown = F.filter("genre_list", lambda g: g.isNull() | ~F.array_contains(known, g))
    reason = (F.when(F.col("occupation").isNull()
                     | ~F.col("occupation").between(0, schema.NUM_OCCUPATION - 1), F.lit(REJECT_REASONS[0]))
              .when(~F.size("genre_list").between(1, schema.MAX_REQUEST_GENRES), F.lit(REJECT_REASONS[1]))
              .when(~F.col("top_n").between(schema.MIN_TOP_N, schema.MAX_TOP_N), F.lit(REJECT_REASONS[2]))
              .when(F.col("gender").isNull() | ~F.col("gender").isin(schema.GENDER_CODES), F.lit(REJECT_REASONS[3]))
              .when(F.col("age").isNull() | ~F.col("age").isin(schema.AGE_CODES), F.lit(REJECT_REASONS[4]))
              .when(F.col("zip_code").isNull(), F.lit(REJECT_REASONS[5]))
              .when(F.size(unknown) > 0, F.lit(REJECT_REASONS[6])))
    return df.withColumn("reject_reason", reason).withColumn("unknown_genres", F.array_join(unknown, ","))


PROFILE = ["gender_idx", "age_idx", "occ_idx", "zip_idx"]


def encode_requests(valid: DataFrame) -> DataFrame:
    """Adds the profile's indices and the request's genre mask."""
    mask = sum((F.when(F.array_contains("genre_list", g), 1 << i).otherwise(0) for i, g in enumerate(schema.GENRES)), F.lit(0))
    return valid.select("*", E.gender_idx("gender").alias("gender_idx"), E.age_idx("age").alias("age_idx"),
                        F.col("occupation").alias("occ_idx"), E.zip_region("zip_code").alias("zip_idx"),
                        mask.cast("int").alias("request_mask"))


def movie_genre_sets(movies: DataFrame) -> DataFrame:
    """Catalogue rows with their genre mask; movies without a known genre can
    never share one with a (validated) request and are left out."""
    return (movies.select("movie_id", "title", "genres", E.genre_mask("genres").alias("genre_mask"))
            .filter(F.col("genre_mask") != 0))


def _bits(masks: DataFrame, mask: str) -> DataFrame:
    """(mask, genre_idx) for every set bit of each distinct mask."""
    bits = F.expr(f"filter(sequence(0, {schema.NUM_GENRES - 1}), i -> (shiftright({mask}, i) & 1) = 1)")
    return masks.select(mask).distinct().select(mask, F.explode(bits).alias("genre_idx"))


def mask_overlaps(encoded: DataFrame, movie_sets: DataFrame) -> DataFrame:
    """(request_mask, genre_mask) that share a genre: an equi-join on the genre of two tables that the
    vocabulary bounds (masks of up to three genres, genre sets of the catalogue), whatever the rows."""
    return (_bits(encoded, "request_mask").join(_bits(movie_sets, "genre_mask"), "genre_idx")
            .select("request_mask", "genre_mask").distinct())


def candidate_counts(requests: DataFrame, movies: DataFrame) -> DataFrame:
    """(request_id, n_candidates) of every valid request: how many movies share a genre with it. The
    candidates themselves are the pairs of ``mask_overlaps``; they are never spelled out per request."""
    enc = encode_requests(validate_requests(requests).filter(F.col("reject_reason").isNull()))
    sets = movie_genre_sets(movies)
    sizes = sets.groupBy("genre_mask").agg(F.count(F.lit(1)).alias("n"))
    counts = mask_overlaps(enc, sets).join(sizes, "genre_mask").groupBy("request_mask").agg(F.sum("n").alias("n"))
    return enc.join(counts, "request_mask", "left").select("request_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_candidates"))


def candidate_links(requests: DataFrame, movies: DataFrame) -> DataFrame:
    """The candidates of all valid requests as classes, (kind, id, mask): 'link' rows say which request mask (id) shares a genre with which genre set
    (mask), 'request' and 'movie' rows which class each request and movie belongs to, one row per row. Joined on the masks they
    give every (request, movie) pair; spelled out, those grow with requests x movies."""
    enc = encode_requests(validate_requests(requests).filter(F.col("reject_reason").isNull()))
    sets = movie_genre_sets(movies)

    def rows(df: DataFrame, kind: str, key: str, mask: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("id"), F.col(mask).cast("long").alias("mask"))
    return (rows(mask_overlaps(enc, sets), "link", "request_mask", "genre_mask").unionByName(rows(enc, "request", "request_id", "request_mask"))
            .unionByName(rows(sets, "movie", "movie_id", "genre_mask")))


def answer_lists(enc: DataFrame, movies: DataFrame, model: Model) -> DataFrame:
    """One row per distinct (profile, request_mask) with a candidate: items, the best ``MAX_TOP_N`` movies as an array
    of (rank, movie_id, title, genres, predicted_rating). Its size is bounded by the vocabularies."""
    sets = movie_genre_sets(movies)
    by_id = Window.partitionBy("genre_mask").orderBy("movie_id")
    best_of_set = (sets.select("genre_mask", "movie_id", F.row_number().over(by_id).alias("rn"))
                   .filter(F.col("rn") <= schema.MAX_TOP_N))
    least = best_of_set.filter(F.col("rn") == 1).select("genre_mask", F.col("movie_id").alias("least_id"))
    asked = enc.select(*PROFILE, "request_mask").distinct()
    pairs = asked.join(mask_overlaps(enc, sets), "request_mask")
    scored = score_arrow(pairs.select(*PROFILE, "genre_mask").distinct(), model, "score")
    # A set after the first 50 (by score, then smallest id) has 50 movies before all of its own.
    by_set = Window.partitionBy(*PROFILE, "request_mask").orderBy(F.desc("score"), F.asc("least_id"))
    kept = (pairs.join(scored, [*PROFILE, "genre_mask"]).join(least, "genre_mask")
            .withColumn("sn", F.row_number().over(by_set)).filter(F.col("sn") <= schema.MAX_TOP_N).drop("sn", "least_id"))
    by_movie = Window.partitionBy(*PROFILE, "request_mask").orderBy(F.desc("score"), F.asc("movie_id"))
    ranked = (kept.join(best_of_set.drop("rn"), "genre_mask").withColumn("rank", F.row_number().over(by_movie))
              .filter(F.col("rank") <= schema.MAX_TOP_N))
    titled = ranked.join(movies.select("movie_id", "title", "genres"), "movie_id")
    item = F.struct("rank", "movie_id", "title", "genres", E.round3("score").alias("predicted_rating"))
    return titled.groupBy(*PROFILE, "request_mask").agg(F.sort_array(F.collect_list(item)).alias("items"))


def recommend_responses(requests: DataFrame, movies: DataFrame, model: Model, known: DataFrame | None = None) -> DataFrame:
    """One row per request, in the order they came or not: the request's columns, status ('answered', 'empty' when no
    movie shares a genre, 'rejected' with reject_reason), the profile as labels and items (top_n movies at most).

    Requests meet their answers by what they ask, not by their ids, so repeated or null ids get whole answers each.
    ``known``: rows of ``answer_lists`` that hold an answer for everything asked, instead of ranking the catalogue."""
    checked = validate_requests(requests)
    valid = F.col("reject_reason").isNull()
    enc = encode_requests(checked.filter(valid))
    lists = answer_lists(enc, movies, model) if known is None else known
    answered = enc.join(lists, [*PROFILE, "request_mask"], "left").drop(*PROFILE, "request_mask")
    every = answered.unionByName(checked.filter(~valid), allowMissingColumns=True)
    items = F.filter(F.coalesce("items", F.array().cast(lists.schema["items"].dataType)), lambda i: i["rank"] <= F.col("top_n"))
    status = F.when(~valid, "rejected").when(F.size("items") > 0, "answered").otherwise("empty")
    return every.withColumn("items", items).select(
        *requests.columns, "reject_reason", "unknown_genres", status.alias("status"), E.gender_label("gender").alias("gender_label"),
        E.age_label("age").alias("age_label"), E.occupation_label("occupation").alias("occupation_label"), "items")


def recommend(requests: DataFrame, movies: DataFrame, model: Model, with_tickets: bool = False) -> DataFrame:
    """The answered requests of ``recommend_responses``, one row per movie: request_id, rank, movie_id, title,
    genres, predicted_rating (score rounded half-even to 3 places). Ties by movie_id."""
    out = recommend_responses(requests, movies, model).select("request_id", F.explode("items").alias("_i")).select(
        "request_id", "_i.rank", "_i.movie_id", "_i.title", "_i.genres", "_i.predicted_rating")
    if with_tickets:
        out = out.select("*", *E.ticket_fields("rank", "genres", "predicted_rating"))
    return out


def asked_profiles(requests: DataFrame) -> DataFrame:
    """Distinct (profile, request_mask) of the valid requests: what an answer depends on, besides catalogue and model."""
    return encode_requests(validate_requests(requests).filter(F.col("reject_reason").isNull())).select(*PROFILE, "request_mask").distinct()


def profile_labels(requests: DataFrame) -> DataFrame:
    """Request codes turned into labels; zip code and genres kept as given."""
    return requests.select("request_id", E.gender_label("gender").alias("gender"),
                           E.age_label("age").alias("age"),
                           E.occupation_label("occupation").alias("occupation"), "zip_code",
                           request_genres(requests).alias("genre_list"))
