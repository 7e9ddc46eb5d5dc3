"""Feature table: ratings joined to users and movies, encoded with native expressions.

Design for scale: both dimension tables are encoded *before* the joins, so the
regex, split and genre matching run once per user / movie instead of once per
rating, and the dimension rows that meet the (huge) ratings side are a few
ints wide. That keeps them under the broadcast threshold for much longer; when
they are not, the join is a sort-merge join; AQE splits a hot user's or
movie's partition (skew join), or ``hot_share`` salts the hot keys. The multi-hot array is rebuilt from the int
genre mask after the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import encoders as E
from .skew import salted_join, salts, with_salt

FEATURE_COLUMNS = ["gender_idx", "age_idx", "occ_idx", "zip_idx", "genres", "rating"]


def encode_users(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        E.gender_idx("gender").alias("gender_idx"),
        E.age_idx("age").alias("age_idx"),
        F.col("occupation").alias("occ_idx"),
        E.zip_region("zip").alias("zip_idx"),
    )


def encode_movies(movies: DataFrame) -> DataFrame:
    return movies.select("movie_id", E.genre_mask("genres").alias("genre_mask"))


def _occ_ok() -> F.Column:
    return F.col("occ_idx").isNotNull() & F.col("occ_idx").between(0, schema.NUM_OCCUPATION - 1)


def joined_features(ratings: DataFrame, users: DataFrame, movies: DataFrame, hot_share: float | None = None) -> DataFrame:
    """All joined rows with keys, encoded features, genre mask and rating. With ``hot_share``, users and movies with over
    that share of the ratings are found first, in the ratings alone, and their rows salted there for both joins (``skew.salted_join``); else skew
    is left to adaptive execution. Movies come first: a mask is one column to carry through the second join, a user four."""
    rows = ratings.select("user_id", "movie_id", "rating", "ts")
    if hot_share is None:
        rows = rows.join(encode_movies(movies), "movie_id").join(encode_users(users), "user_id")
    else:
        hot = salts(rows, ["movie_id", "user_id"], hot_share)
        for key in hot:
            rows = with_salt(rows, key, hot[key], f"_salt_{key}")
        rows = salted_join(rows, encode_movies(movies), "movie_id", table=hot["movie_id"], salt="_salt_movie_id")
        rows = salted_join(rows, encode_users(users), "user_id", table=hot["user_id"], salt="_salt_user_id")
    return (rows
            .select("user_id", "movie_id", "ts", "gender_idx", "age_idx", "occ_idx", "zip_idx",
                    "genre_mask", E.multihot_from_mask("genre_mask").alias("genres"), "rating"))


def build_features(ratings: DataFrame, users: DataFrame, movies: DataFrame,
                   keep_keys: bool = False, hot_share: float | None = None) -> DataFrame:
    """Model-ready rows: gender_idx, age_idx, occ_idx, zip_idx (int), genres
    (array<float>[18]), rating (float); plus genre_mask. With ``keep_keys`` the
    rating keys (user_id, movie_id, ts) stay for splitting.

    Rows whose occupation is null or outside 0-20 cannot be embedded; they go to
    :func:`feature_rejects` instead.
    """
    df = joined_features(ratings, users, movies, hot_share).filter(_occ_ok())
    cols = (["user_id", "movie_id", "ts"] if keep_keys else []) + FEATURE_COLUMNS + ["genre_mask"]
    return df.select(*cols)


def feature_rejects(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """Joined rows that cannot be encoded, with the reason."""
    return (joined_features(ratings, users, movies).filter(~_occ_ok())
            .withColumn("reject_reason", F.lit("occupation out of range")))


def features_report(features: DataFrame) -> DataFrame:
    """Features with the multi-hot as a 0/1 string (comparable across engines)."""
    return features.select("gender_idx", "age_idx", "occ_idx", "zip_idx",
                           E.multihot_string("genres").alias("genres"),
                           F.col("rating").cast("double").alias("rating"))
