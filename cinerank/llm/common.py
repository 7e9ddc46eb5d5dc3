"""Helpers shared by the training-data operators: reading tables, scratch tables in
the cluster's shared folder, row locators, connected components."""

from __future__ import annotations

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The white space of the contracts: [\x20\x09-\x0D], as a Java pattern class.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: it is computed
    once, its lineage ends here, and a lost executor only rereads files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def place(docs: DataFrame) -> Column:
    """The hidden file metadata of ``docs``, also where a column of its own is called ``_metadata``."""
    return docs.metadataColumn("_metadata")


def stored(docs: DataFrame) -> DataFrame:
    """``docs`` if it is read straight from Parquet, so that its rows have a place; else written first.
    Operators call it once, so that all their reads see the same rows at the same places."""
    try:
        docs.select(place(docs)["row_index"]).schema
        return docs
    except AnalysisException:
        return written(docs, "input")


def with_locator(docs: DataFrame, *columns: Column | str, file: str = "_file", row: str = "_row") -> DataFrame:
    """The ``columns`` and where each row lies: a hash of its Parquet file's path and its row index there.
    The pair names one row and stays the same however often the file is read. ``docs`` is ``stored``."""
    at = place(docs)
    return docs.select(*columns, F.xxhash64(at["file_path"]).alias(file), at["row_index"].alias(row))


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (a[i], b[i]) as stars: each linked node that isn't the smallest of its
    component, and that smallest node. At most one row per node, however dense the links."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inv[:len(a)], inv[len(a):]
    label = np.arange(len(nodes))
    while True:
        lu, lv = label[u], label[v]
        if (lu == lv).all():
            break
        low = np.minimum(lu, lv)
        np.minimum.at(label, lu, low)
        np.minimum.at(label, lv, low)
        while (label[label] != label).any():
            label = label[label]
    off = label != np.arange(len(nodes))
    return nodes[off], nodes[label[off]]


def components(links: DataFrame, name: str) -> DataFrame:
    """Connected components of ``links`` (a long, b long): one row (node, root) per
    linked node, root being the component's smallest node.

    Large-star and small-star rounds: each is a group-by (combined before the shuffle,
    so a node with many links costs one row per map task) and a join whose hot side
    adaptive execution may split. The links of a round are written to the shared folder.
    Rounds go on until the stars stand still; nothing but two sums reaches the driver.
    """
    def summed(df):
        return df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()

    def star(df, large: bool):
        if large:
            df = df.select("a", "b").union(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            df = df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = df.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("a", "_m"))
        df = df.join(low, "a")
        if large:
            out = df.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        else:
            out = df.select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("_m").alias("b"))
        return out.where("a <> b").distinct()

    links = written(links.where("a <> b").select("a", "b").distinct(), f"{name}-links")
    before = None
    while True:
        now = summed(links)
        if now == before or now[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
        links = written(star(star(links, True), False), f"{name}-links")
