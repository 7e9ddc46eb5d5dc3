"""Double-colon delimited text tables (ratings / users / movies) and result sinks."""

from __future__ import annotations

import json
import os
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema

FILE_NAMES = {"ratings": "ratings.dat", "users": "users.dat", "movies": "movies.dat"}
SCHEMAS = {"ratings": schema.RATINGS_SCHEMA, "users": schema.USERS_SCHEMA, "movies": schema.MOVIES_SCHEMA}


def drop_null_keys(df: DataFrame, required=()) -> DataFrame:
    """Rows with all of ``required``."""
    return df.dropna(subset=list(required)) if required else df


def read_dat(spark: SparkSession, path: str, struct: T.StructType, required=()) -> DataFrame:
    """Read ``::``-separated Latin-1 text with a fixed schema.

    A field that does not parse becomes null and short lines get trailing nulls
    (permissive mode); literal quote characters are kept. Rows with a null in
    ``required`` are dropped.
    """
    df = (spark.read.schema(struct)
          .option("sep", "::")
          .option("quote", "")
          .option("escape", "")
          .option("encoding", "ISO-8859-1")
          .option("header", "false")
          .option("mode", "PERMISSIVE")
          .option("nullValue", "")
          .csv(path))
    return drop_null_keys(df, required)


def parse_dat_lines(lines: DataFrame, struct: T.StructType, required=(), col: str = "value") -> DataFrame:
    """Typed columns from in-memory '::' lines (e.g. a text stream): split, pick
    field i with ``get`` (null past the end) and ``try_cast`` (null when it does
    not parse), so bad rows become nulls instead of failing under ANSI mode."""
    parts = F.split(F.col(col), "::")
    df = lines.select(*[F.get(parts, i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(struct.fields)])
    return drop_null_keys(df, required)


class Tables(NamedTuple):
    ratings: DataFrame
    users: DataFrame
    movies: DataFrame


def load_tables(spark: SparkSession, data_dir: str) -> Tables:
    """ratings, users and movies from ``data_dir``; fails listing every missing file."""
    frames, missing = {}, []
    for name, fname in FILE_NAMES.items():
        path = os.path.join(data_dir, fname)
        try:
            frames[name] = read_dat(spark, path, SCHEMAS[name], schema.REQUIRED_COLUMNS[name])
            frames[name].schema  # noqa: B018 - resolves the path now
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                missing.append(path)
            else:
                raise
    if missing:
        raise FileNotFoundError(f"Missing data files: {missing}")
    return Tables(frames["ratings"], frames["users"], frames["movies"])


def write_dat(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as ``::``-separated Latin-1 text (nulls as empty fields, and so are empty strings:
    both are read back as null). A value that the format can't hold, with a separator, a line end or a
    character outside Latin-1, fails the job instead of being changed."""
    def safe(c):
        v = F.col(c).cast("string")
        return F.when(v.rlike(r"::|[\r\n]|[^\x{0}-\x{FF}]|^:|:$"), F.raise_error(F.concat(F.lit(f"{c} can't be written as '::' Latin-1 text: "), v))).otherwise(v)

    cols = [F.coalesce(safe(c), F.lit("")) for c in df.columns]
    (df.select(F.concat_ws("::", *cols).alias("value"))
     .write.mode(mode)
     .option("sep", "\u0001")
     .option("quote", "")
     .option("escape", "")
     .option("encoding", "ISO-8859-1")
     .csv(path))


def write_metrics(spark: SparkSession, path: str, record: dict) -> DataFrame:
    """Write one JSON record (config, cardinalities, losses, metrics) as a
    single-row JSON file and return it as a DataFrame."""
    df = spark.createDataFrame([(json.dumps(record, sort_keys=True, default=float),)], "record string")
    df.coalesce(1).write.mode("overwrite").text(path)
    return df
