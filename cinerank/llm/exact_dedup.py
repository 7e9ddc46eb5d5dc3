"""Exact deduplication as a stateful stream.

Each batch of documents is appended to a digest log (one row per document: digest of
the normalised text, original length, identifier, and the content locator, i.e. the
file and row that hold the text). A Structured Streaming query reads the log and keeps
one state row per digest without expiry, in RocksDB on the executors' disks with
its checkpoint in the shared folder: the identifier and locator of the document that
stays, and the size of the group. A group is combined before the shuffle, so copies of
one text cost one row per map task. Stopping and starting again resumes from the
checkpoint; later batches meet the digests of all earlier ones.

A digest that occurs again is a hit: the full bytes of hits are fetched by locator, those of earlier
batches from the files that the log names, and compared (smallest against largest text of each digest, again combined before the
shuffle). Texts that share a digest without being equal are then separated by text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import SPACE, place, stored, with_locator, written

LOG = "digest string, n_points long, no_id boolean, doc_id long, _file long, _row long, path string, call string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    """The bytes that are compared: the text without [\x20\x09-\x0D]; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def sha256(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


class DedupState:
    """The digest log, its stream and its state, all under one folder of the shared store."""

    def __init__(self, spark: SparkSession, home: str | None = None):
        self.spark = spark
        self.home = home or scratch_path(spark, "exact-dedup")

    def add(self, log: DataFrame, files_per_batch: int = 512) -> None:
        """Append rows of the log and run the stream over what is new."""
        spark = self.spark
        log.write.mode("append").parquet(f"{self.home}/log")
        best = F.min(F.struct((-F.col("n_points")).alias("neg_points"), "no_id", "doc_id", "_file", "_row"))
        state = (spark.readStream.schema(LOG).option("maxFilesPerTrigger", files_per_batch).parquet(f"{self.home}/log")
                 .groupBy("digest").agg(best.alias("best"), F.count("*").alias("n")))
        settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
                    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # megabytes of empty disk per partition
                    "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # no store stays open beside the running tasks
                    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
                    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256"}
        old = {k: spark.conf.get(k, None) for k in settings}
        try:
            for k, v in settings.items():
                spark.conf.set(k, v)
            query = (state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
                     .queryName(f"exact-dedup-{uuid.uuid4().hex[:8]}")
                     .option("checkpointLocation", f"{self.home}/checkpoint").start())
            query.awaitTermination()
        finally:
            for k, v in old.items():
                spark.conf.set(k, v) if v is not None else spark.conf.unset(k)

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(f"{self.home}/log")

    def groups(self) -> DataFrame:
        """(digest, best struct, n long): the state as the last batch left it."""
        state = self.spark.read.format("statestore").load(f"{self.home}/checkpoint")
        values = [f.name for f in state.schema["value"].dataType.fields]
        return state.select(F.col("key.digest").alias("digest"), F.col(f"value.`{values[0]}`").alias("best"),
                            F.col(f"value.`{values[1]}`").alias("n"))


def exact_dedup(docs: DataFrame, state: DedupState | None = None, digest: Callable[[Column], Column] = sha256,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id_col, keep_id, group_size, kept, text_sha256, _file, _row).

    Texts are equal when they are identical without [\x20\x09-\x0D]; null counts as empty, and
    empty texts are equal to each other. Of equal texts the row with the most code points in
    the original text stays, then the smallest id (null last), then the first by locator: of
    rows that repeat wholly exactly one stays. Other columns are ignored; an empty table gives
    an empty result. ``digest`` maps the normalised text to the state's key; a weak one only
    makes the comparison of full bytes do more work. With a ``state`` that has seen documents
    before, the result has the rows of this call, judged against all documents so far.
    """
    spark = docs.sparkSession
    continued, state, call = state is not None, state or DedupState(spark), uuid.uuid4().hex
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    docs = stored(docs)
    located = with_locator(docs, F.col(id_col).cast("long").alias("doc_id"), text, place(docs)["file_path"].alias("path"))
    norm = normalised(F.col("text"))
    log = located.select(digest(norm).alias("digest"), F.length("text").cast("long").alias("n_points"),
                         F.col("doc_id").isNull().alias("no_id"), "doc_id", "_file", "_row", "path", F.lit(call).alias("call"))
    state.add(log)
    groups = written(state.groups(), "exact-dedup-groups")
    everything = state.log().join(groups, "digest")
    rows = everything.where(F.col("call") == call)
    # Hits: full bytes of every group of two or more, by locator.
    members = rows.where("n > 1").select("_file", "_row", "digest")
    texts = located.join(members, ["_file", "_row"]).select("digest", "doc_id", "text", norm.alias("norm"), "_file", "_row", F.lit(True).alias("now"))
    if continued:  # and of their members from earlier calls, from their files
        earlier = everything.where((F.col("n") > 1) & (F.col("call") != call)).join(members.select("digest").distinct(), "digest", "left_semi")
        earlier = written(earlier.select("digest", "doc_id", "_file", "_row", "path"), "exact-dedup-earlier")
        paths = [r["path"] for r in earlier.select("path").distinct().collect()]  # files, not rows; as URIs
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(p)) for p in paths]
        if paths:
            before = with_locator(spark.read.schema(f"`{text_col}` string").parquet(*paths), text)
            before = before.join(earlier, ["_file", "_row"]).select("digest", "doc_id", "text", norm.alias("norm"), "_file", "_row", F.lit(False).alias("now"))
            texts = texts.unionByName(before)
    clash = written(texts.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
                    .where("low <> high").select("digest"), "exact-dedup-clashes")
    strong = digest is sha256
    decided = rows.select("doc_id", "_file", "_row", "digest", "best", "n")
    if not clash.isEmpty():
        mixed = texts.join(clash, "digest")
        best = F.min(F.struct((-F.length("text")).cast("long").alias("neg_points"), F.col("doc_id").isNull().alias("no_id"),
                              "doc_id", "_file", "_row"))
        apart = mixed.groupBy("digest", "norm").agg(best.alias("best"), F.count("*").alias("n"))
        again = mixed.where("now").select("digest", "norm", "doc_id", "_file", "_row").join(apart, ["digest", "norm"])
        decided = decided.join(clash, "digest", "left_anti").unionByName(again.drop("norm"))
    out = decided.select(F.col("doc_id").alias(id_col), F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                         ((F.col("_file") == F.col("best._file")) & (F.col("_row") == F.col("best._row"))).alias("kept"),
                         "digest", "_file", "_row")
    if strong:
        return out.withColumnRenamed("digest", "text_sha256")
    sums = located.select("_file", "_row", sha256(norm).alias("text_sha256"))
    return out.drop("digest").join(sums, ["_file", "_row"])
