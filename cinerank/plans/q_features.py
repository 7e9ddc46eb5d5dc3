"""Registered queries for reading, feature encoding, splitting and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import encoders as E
from ..operators import features as FE
from ..operators import split as S
from ..session import scratch_path
from ..sources import dat
from ..sources.fixtures import load_fixture
from .registry import (age_idx_sql, gender_idx_sql, genre_parts_sql, multihot_string_sql, register,
                       sql_with, zip_idx_sql)

SEED = 42
SAMPLE_CAP = 5_000           # the capped sample's size, less than the fixture's test rows
SAMPLE_CAP_LARGE = 50_000    # as large as the default of a run; cuts from sf0.1 on

_FEATURES_CTE = ("feat", f"""select r.user_id, r.movie_id, r.ts,
    {gender_idx_sql('u.gender')} as gender_idx, {age_idx_sql('u.age')} as age_idx,
    u.occupation as occ_idx, {zip_idx_sql('u.zip')} as zip_idx,
    {multihot_string_sql(genre_parts_sql('m.genres'))} as genres,
    cast(r.rating as double) as rating
  from ratings r join users u on r.user_id = u.user_id join movies m on r.movie_id = m.movie_id
  where u.occupation between 0 and 20""")

_KEY = "concat_ws('|', user_id, movie_id, ts, '42')"
_SPLIT_CTE = ("labelled", f"""select *, case when
    cast('0x' || substr(md5({_KEY}), 1, 8) as bigint) % 1000 < 800 then 'train' else 'test' end as split
  from feat""")
_REPORT_COLS = "gender_idx, age_idx, occ_idx, zip_idx, genres, rating"


def fixture_features(spark, sf_dir, keep_keys=True):
    t = load_fixture(spark, sf_dir)
    return FE.build_features(t.ratings, t.users, t.movies, keep_keys=keep_keys)


def report_with_keys(feats):
    return feats.select("user_id", "movie_id", "ts", "gender_idx", "age_idx", "occ_idx", "zip_idx",
                        E.multihot_string("genres").alias("genres"),
                        F.col("rating").cast("double").alias("rating"))


@register("read_dat_roundtrip", sql_with(["users"], body="select * from users"))
def q_read_dat_roundtrip(spark, sf_dir):
    """Fixture users written as '::' Latin-1 text to the shared scratch folder and read back."""
    users = load_fixture(spark, sf_dir).users
    path = scratch_path(spark, "users-dat")
    dat.write_dat(users, path)
    return dat.read_dat(spark, path, dat.SCHEMAS["users"], ["user_id"])


@register("features", sql_with(["ratings", "users", "movies"], [_FEATURES_CTE],
                               body=f"select {_REPORT_COLS} from feat"))
def q_features(spark, sf_dir):
    return FE.features_report(fixture_features(spark, sf_dir, keep_keys=False))


@register("features_salted", sql_with(["ratings", "users", "movies"], [_FEATURES_CTE], body=f"select {_REPORT_COLS} from feat"))
def q_features_salted(spark, sf_dir):
    """The same rows through joins that salt every user and movie with over 0.1 % of the ratings."""
    t = load_fixture(spark, sf_dir)
    return FE.features_report(FE.build_features(t.ratings, t.users, t.movies, hot_share=0.001))


@register("feature_rejects", sql_with(["ratings", "users", "movies"], body="""
select r.user_id, r.movie_id, u.occupation as occ_idx from ratings r
  join users u on r.user_id = u.user_id join movies m on r.movie_id = m.movie_id
where u.occupation is null or u.occupation not between 0 and 20"""))
def q_feature_rejects(spark, sf_dir):
    t = load_fixture(spark, sf_dir)
    return FE.feature_rejects(t.ratings, t.users, t.movies).select("user_id", "movie_id", "occ_idx")


@register("hash_split", sql_with(["ratings", "users", "movies"], [_FEATURES_CTE, _SPLIT_CTE],
                                 body=f"select {_REPORT_COLS}, split from labelled"))
def q_hash_split(spark, sf_dir):
    labelled = S.with_split(report_with_keys(fixture_features(spark, sf_dir)), seed=SEED)
    return labelled.drop("user_id", "movie_id", "ts")


@register("split_summary", sql_with(["ratings", "users", "movies"], [_FEATURES_CTE, _SPLIT_CTE], body="""
select split, cast(count(*) as bigint) as n,
  round(count(*) / sum(count(*)) over (), 6) as share
from labelled group by split"""))
def q_split_summary(spark, sf_dir):
    return S.split_summary(S.with_split(fixture_features(spark, sf_dir), seed=SEED))


@register("random_split", sql_with(["ratings", "users", "movies"], [_FEATURES_CTE], body=f"""
select {_REPORT_COLS}, cast(1 as bigint) as sides, cast(count(*) over () as bigint) as n, cast(0 as bigint) as in_both,
  cast(count(*) over () as bigint) as in_one, true as share_within from feat"""))
def q_random_split(spark, sf_dir):
    """The rows of both sides, each with the number of sides it is in, and the sides judged: rows of both together, rows (numbered before
    the split) in both, rows in just one, and whether the train side holds 0.8 of them to within five standard deviations."""
    rows, _ = S.numbered(fixture_features(spark, sf_dir), S.RATING_KEY, SEED)
    sides = S.random_split(rows, 0.8, SEED)
    both = sides[0].withColumn("_t", F.lit(1)).unionByName(sides[1].withColumn("_t", F.lit(0)))
    per_row = both.groupBy("_pos").agg(F.sum("_t").cast("long").alias("t"), F.sum(1 - F.col("_t")).cast("long").alias("e"))
    n, k = F.sum(F.col("t") + F.col("e")), F.sum("t")
    judged = per_row.agg(n.alias("n"), F.sum(((F.col("t") > 0) & (F.col("e") > 0)).cast("long")).alias("in_both"), F.sum((F.col("t") + F.col("e") == 1).cast("long")).alias("in_one"),
                         (F.abs(k - 0.8 * n) <= 5 * F.sqrt(0.16 * n)).alias("share_within"))
    counted = both.join(per_row.select("_pos", (F.col("t") + F.col("e")).alias("sides")), "_pos")
    report = FE.features_report(counted).columns
    return (counted.withColumn("genres", E.multihot_string("genres")).withColumn("rating", F.col("rating").cast("double"))
            .select(*report, "sides").crossJoin(F.broadcast(judged)))  # one row


def fixture_test_set(spark, sf_dir):
    _, test = S.hash_split(report_with_keys(fixture_features(spark, sf_dir)), seed=SEED)
    return test


def _sample_cap_query(name: str, cap: int) -> None:
    @register(name, sql_with(["ratings", "users", "movies"], [_FEATURES_CTE, _SPLIT_CTE], body=f"""
select {_REPORT_COLS} from labelled where split = 'test'
order by cast('0x' || substr(md5({_KEY}), 1, 15) as bigint),
  user_id, movie_id, ts, {_REPORT_COLS}
limit {cap}"""))
    def q(spark, sf_dir):
        return S.sample_cap(fixture_test_set(spark, sf_dir), cap, S.RATING_KEY, SEED).drop("user_id", "movie_id", "ts")


_sample_cap_query("sample_cap", SAMPLE_CAP)
_sample_cap_query("sample_cap_large", SAMPLE_CAP_LARGE)


_ALL_COLS = f"user_id, movie_id, ts, {_REPORT_COLS}"


def recursive(sql: str) -> str:
    return sql.replace("with ", "with recursive ", 1)


@register("permute_column", recursive(sql_with(["ratings", "users", "movies"], [
    _FEATURES_CTE, _SPLIT_CTE,
    ("test", f"select *, row_number() over (order by md5({_KEY}), {_ALL_COLS}) - 1 as pos from labelled where split = 'test'"),
    *S.bijection_sql("moved", "test", SEED, "age_idx"),
], body="""select r.gender_idx, v.age_idx, r.occ_idx, r.zip_idx, r.genres, r.rating
from test r join moved on moved.x = r.pos join test v on v.pos = moved.pos""")))
def q_permute_column(spark, sf_dir):
    test = fixture_test_set(spark, sf_dir)
    return S.permute_column(test, "age_idx", S.RATING_KEY, SEED, order_cols=test.columns).drop("user_id", "movie_id", "ts")
