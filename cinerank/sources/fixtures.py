"""Rating, user, movie and request tables derived from the driver's parquet tables.

Each derived table is one SELECT that Spark and DuckDB both run; Spark reads the
parquet files directly (``parquet.`path```), the DuckDB oracle reads the
pre-registered base views and inlines these SELECTs as CTEs. The derivation
rules are our own fixture design (see FIXTURES.md section 2).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import GENRES, REQUIRED_COLUMNS
from .dat import drop_null_keys

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def _genre_case(expr: str) -> str:
    whens = " ".join(
        "when {} then '{}'".format(i, g.replace("'", "''")) for i, g in enumerate(GENRES))
    return f"(case {expr} {whens} end)"


_ZIP5 = "lpad(cast((c_custkey*37)%100000 as string),5,'0')"

_AGE_CASE = ("case c_custkey%7 when 0 then 1 when 1 then 18 when 2 then 25 when 3 then 35 "
             "when 4 then 45 when 5 then 50 else 56 end")


def _users_sql(t) -> str:
    return f"""
select cast(case when c_custkey%60<>59 then c_custkey end as int) as user_id,
  case when c_custkey%101=100 then 'X' when c_custkey%2=0 then 'M' else 'F' end as gender,
  {_AGE_CASE} as age,
  cast(case when c_custkey%71=70 then null when c_custkey%67=66 then 21+c_custkey%3 else c_custkey%21 end as int) as occupation,
  case when c_custkey%97=96 then null when c_custkey%89=88 then 'V5K'
       when c_custkey%13=12 then concat({_ZIP5},'-1234') else {_ZIP5} end as zip
from {t('customer')}"""


def _movies_sql(t) -> str:
    g1 = _genre_case("cast(p_partkey%18 as int)")
    g2 = _genre_case("cast(floor(p_partkey/18) as int)%18")
    return f"""
select cast(case when p_partkey%50<>49 then p_partkey end as int) as movie_id,
  concat(p_name,' #',cast(p_partkey as string)) as title,
  case when p_partkey%83=82 then '' when p_partkey%79=78 then 'Unlisted| Drama '
       else concat({g1},'|',{g2}) end as genres
from {t('part')}"""


def _ratings_sql(t, dialect: str) -> str:
    # Whole days since 1970 in seconds; March 1995 is moved to April, so that one month has no ratings.
    day = ("cast(datediff(cast(l_shipdate as date), date'1970-01-01') as bigint) * 86400" if dialect == "spark"
           else "cast(epoch(cast(l_shipdate as date)) as bigint)")
    ts = f"{day} + case when {day} between 794016000 and 796694399 then 2678400 else 0 end"
    return f"""
select cast(o_custkey as int) as user_id, cast(l_partkey as int) as movie_id,
  cast(1
   + case when l_quantity>25 then 1 else 0 end
   + case when o_custkey%7>=4 then 1 else 0 end
   + case when (o_custkey%2=1)<>(least(l_partkey%18,cast(floor(l_partkey/18) as int)%18)<5) then 1 else 0 end
   + case when greatest(l_partkey%18,cast(floor(l_partkey/18) as int)%18)>=13 then 1 else 0 end
  as float) as rating, {ts} as ts
from {t('lineitem')} join {t('orders')} on l_orderkey=o_orderkey"""


def _requests_sql(t, dialect: str) -> str:
    # Every 31st request repeats the id before it and every 73rd has none: answers must not mix. The
    # oracle tells rows apart by rk, which Spark doesn't see.
    rk = "" if dialect == "spark" else ", c_custkey as rk"
    g = lambda off: _genre_case(f"cast((c_custkey+{off})%18 as int)")
    return f"""
select case when c_custkey%73=72 then null when c_custkey%31=30 then c_custkey-1 else c_custkey end as request_id,
  case when c_custkey%44=40 then 'X' when c_custkey%8=0 then 'M' else 'F' end as gender,
  case when c_custkey%52=48 then 30 else {_AGE_CASE} end as age,
  case when c_custkey%60=56 then 21 else cast(c_custkey%21 as int) end as occupation,
  case when c_custkey%47=46 then null when c_custkey%89=88 then 'V5K' else {_ZIP5} end as zip_code,
  case when c_custkey%100=96 then '' when c_custkey%68=64 then 'Polka'
       when c_custkey%3=0 then {g(0)}
       when c_custkey%3=1 then concat({g(0)},'|',{g(5)})
       else concat({g(0)},'|',{g(5)},'|',{g(11)})
  end as genres,
  case when c_custkey%76=72 then 0 else cast(1+c_custkey%50 as int) end as top_n{rk}
from {t('customer')}"""


def view_sql(name: str, dialect: str, sf_dir: str | None = None) -> str:
    """The SELECT for one derived table, for ``dialect`` 'spark' or 'duckdb'."""
    if dialect == "spark":
        def t(base):
            return f"parquet.`{sf_dir}/{base}.parquet`"
    else:
        def t(base):
            return base
    if name == "ratings":
        return _ratings_sql(t, dialect)
    if name == "requests":
        return _requests_sql(t, dialect)
    sql = {"users": _users_sql, "movies": _movies_sql}[name](t)
    if dialect == "spark":
        return sql  # null keys are dropped by drop_null_keys
    return f"select * from ({sql}) where {REQUIRED_COLUMNS[name][0]} is not null"


class Tables(NamedTuple):
    ratings: DataFrame
    users: DataFrame
    movies: DataFrame


def load_fixture(spark: SparkSession, sf_dir: str) -> Tables:
    """ratings / users / movies with the native schemas, derived from ``sf_dir``."""
    return Tables(*(drop_null_keys(spark.sql(view_sql(n, "spark", sf_dir)), REQUIRED_COLUMNS[n]) for n in ("ratings", "users", "movies")))


def load_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer; genres as a list of names."""
    return spark.sql(view_sql("requests", "spark", sf_dir)).withColumn(
        "genres", F.when(F.col("genres") == "", F.array().cast("array<string>")).otherwise(F.split("genres", "[|]")))
