"""Joins whose big side has hot keys: heavy hitters found by a mergeable summary, their rows salted, all others joined as they are."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import cut_lineage


def _count(kept: Counter, column: pa.Array, size: int) -> Counter:
    """Misra-Gries: ``kept`` with the values of ``column``, at most ``size`` of them; a count is short by at most rows / size."""
    for r in column.drop_null().value_counts():
        kept[r["values"].as_py()] += r["counts"].as_py()
    if len(kept) > size:
        cut = sorted(kept.values(), reverse=True)[size]
        kept = Counter({k: n - cut for k, n in kept.items() if n > cut})
    return kept


def _tallied(df: DataFrame, keys: list[str], size: int) -> tuple[list[DataFrame], int]:
    """(The tasks' summaries (key, n) of each of the ``keys``, stored; number of rows), in one pass over ``df``."""
    kinds = [df.schema[k].dataType for k in keys]
    types = [to_arrow_type(k) for k in kinds]
    names = ["which", "n", *(f"key{i}" for i in range(len(keys)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [Counter() for _ in types], 0
        for batch in batches:
            rows += batch.num_rows
            kept = [_count(c, batch.column(i), size) for i, c in enumerate(kept)]

        def out(which, n, values=()):
            own = [pa.array(values, t) if i == which else pa.nulls(len(n), t) for i, t in enumerate(types)]
            return pa.RecordBatch.from_arrays([pa.array([which] * len(n), pa.int32()), pa.array(n, pa.int64()), *own], names)

        if rows:
            yield out(-1, [rows])
            yield from (out(i, list(c.values()), list(c)) for i, c in enumerate(kept) if c)

    schema = "which int, n long" + "".join(f", key{i} {k.simpleString()}" for i, k in enumerate(kinds))
    parts = cut_lineage(df.select(*[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)]).mapInArrow(run, schema))  # 4 / share short rows a task
    rows = int(parts.where("which = -1").agg(F.sum("n")).first()[0] or 0)
    return [parts.where(F.col("which") == i).select(F.col(f"key{i}").alias("key"), "n") for i in range(len(keys))], rows


def _over(parts: DataFrame, rows: int, share: float) -> DataFrame:
    return parts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= 0.75 * share * rows)


def heavy_hitters(df: DataFrame, key: str, share: float) -> DataFrame:
    """(key, n): the keys with over ``share`` of all rows of ``df`` and perhaps some with over three quarters of it; n is at most their number of rows.

    Each task keeps 4 / share counters; what a key loses is at most a quarter of ``share`` of all rows, so keys over the share keep three quarters of
    it. At most 4 / (3 share) keys come out, whatever the table. ``df`` is read once."""
    (parts,), rows = _tallied(df, [key], int(4 / share) + 1)
    return _over(parts, rows, share)


def salts(df: DataFrame, keys: list[str], share: float) -> dict[str, DataFrame]:
    """For each of the ``keys`` (_key, _salts): the values with over ``share`` of the rows of ``df`` and the number of salts that each asks for;
    bounded by the share. ``df`` is read once for all keys."""
    tallies, rows = _tallied(df, keys, int(4 / share) + 1)
    out = {}
    for key, parts in zip(keys, tallies):
        hot = _over(parts, rows, share).collect()  # bounded by the share
        out[key] = df.sparkSession.createDataFrame([(r["key"], max(2, -(-int(r["n"] / share) // max(rows, 1)))) for r in hot],
                                                   f"_key {df.schema[key].dataType.simpleString()}, _salts int")
    return out


def _named(df: DataFrame, key: str, table: DataFrame) -> DataFrame:
    return df.join(F.broadcast(table), df[key] == F.col("_key"), "left").drop("_key")


def with_salt(big: DataFrame, key: str, table: DataFrame, salt: str = "_salt") -> DataFrame:
    """``big`` with the salt of each row for a join on ``key``, by what ``salts`` found."""
    random = F.xxhash64(*big.columns)  # of the row itself, so that a task that runs again deals its rows alike
    return _named(big, key, table).withColumn(salt, F.when(F.col("_salts").isNotNull(), F.pmod(random, F.col("_salts")))
                                              .when(F.col(key).isNull(), F.pmod(random, F.lit(1024))).otherwise(0).cast("int")).drop("_salts")


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner", share: float = 0.01, table: DataFrame | None = None,
                salt: str | None = None) -> DataFrame:
    """``big`` joined to ``small`` on ``key`` (inner or left), where some keys may hold much of ``big``.

    Rows of ``big`` with a hot key (over ``share`` of the rows) get one of as many salts as the key's share asks for, and ``small``'s row of that key is
    repeated once a salt; rows of other keys have salt 0. Rows equal in all columns share a salt. Hot keys are at most 4 / (3 share), so their table is broadcast. A salted key's
    rows spread over tasks, each of which gets at most about ``share`` of all rows of any key. Null keys match nothing; with ``left`` they stay, spread over tasks too.

    Without ``table``, ``big`` is read once more to find the hot keys. A caller that joins several times finds them all at once in the first table (``salts``) and
    may give its rows all their salts there (``with_salt``; ``salt`` names the column, which is dropped), so that later joins need not carry the columns that salts are made of.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join is inner or left")
    if table is None:
        table = salts(big, [key], share)[key]
    left = with_salt(big, key, table) if salt is None else big.withColumnRenamed(salt, "_salt")
    right = _named(small.where(F.col(key).isNotNull()), key, table).withColumn("_salt", F.explode(F.expr("sequence(0, coalesce(_salts, 1) - 1)")))
    right = right.drop("_salts").withColumnRenamed(key, "_key2").withColumnRenamed("_salt", "_salt2")
    # Null keys get a salt of their own, so that a left join spreads them; they equal nothing.
    on = (F.col(key) == F.col("_key2")) & (F.col("_salt") == F.col("_salt2"))
    return left.join(right, on, how).drop("_salt", "_key2", "_salt2")
