"""Recommendation over a stream of request files (JSON lines).

Answered, empty and rejected requests alike reach the sink, as :func:`recommend_responses` has them. What has been answered is kept: a table of answers
keyed by (profile, genre mask) lies under ``<out>/_answers/version=<v>``, and a micro-batch ranks the catalogue only for keys that are not in it. Its size
is bounded by the vocabularies. The version is a hash of model and catalogue; a stream that starts with another one drops the answers of the
old. Each batch adds its own part in overwrite mode, and doesn't read it, so a replay makes the same part again. The sink writes each batch to ``<out>/batch_id=<n>`` in
overwrite mode, so a replayed batch after a failure replaces its own output instead of
duplicating it. The stream's checkpoint lies in the output folder unless given: a
restart on the same output goes on where the last run ended.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model.score import Model
from ..operators.recommend import PROFILE, REQUEST_SCHEMA, answer_lists, asked_profiles, recommend_responses

KEY = [*PROFILE, "request_mask"]


def answers_version(movies: DataFrame, model: Model) -> str:
    """A hash of the network's parameters and of the catalogue's rows."""
    digest = hashlib.md5(json.dumps(model.spec.to_dict(), sort_keys=True).encode())
    for name in sorted(model.params):
        digest.update(name.encode() + np.ascontiguousarray(model.params[name], np.float64).tobytes())
    rows = movies.agg(F.count(F.lit(1)), F.sum(F.xxhash64("movie_id", "title", "genres").cast("decimal(38,0)"))).first()
    digest.update(repr(tuple(rows)).encode())
    return digest.hexdigest()


def drop_other_versions(spark: SparkSession, path: str, version: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in fs.listStatus(at) if fs.exists(at) else []:
        if entry.getPath().getName() != f"version={version}":
            fs.delete(entry.getPath(), True)


def known_answers(batch: DataFrame, batch_id: int, movies: DataFrame, model: Model, path: str) -> DataFrame:
    """Answers to all that ``batch`` asks: those in ``path`` from other batches, and, ranked and stored now, the rest."""
    spark = batch.sparkSession
    asked = asked_profiles(batch)
    lists = answer_lists(asked.limit(0), movies, model)
    stored_schema = T.StructType([*lists.schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        stored = spark.read.schema(stored_schema).parquet(path).where(F.col("batch_id") != batch_id).drop("batch_id")
    except AnalysisException:  # the first batch of this version
        stored = lists
    new = asked.join(stored.select(*KEY), KEY, "left_anti")
    ranked = new.join(answer_lists(new, movies, model), KEY, "left")  # without a candidate: an empty list
    none = F.array().cast(lists.schema["items"].dataType)
    ranked.withColumn("items", F.coalesce("items", none)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return stored.unionByName(spark.read.schema(lists.schema).parquet(f"{path}/batch_id={batch_id}"))


def start_recommend_stream(spark: SparkSession, request_dir: str, movies: DataFrame, model: Model,
                           out_dir: str, checkpoint: str | None = None, available_now: bool = True,
                           max_files_per_trigger: int | None = None):
    """Start the streaming query; returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.json(request_dir)

    version = answers_version(movies, model)
    drop_other_versions(spark, f"{out_dir}/_answers", version)

    def each_batch(batch: DataFrame, batch_id: int):
        known = known_answers(batch, batch_id, movies, model, f"{out_dir}/_answers/version={version}")
        recommend_responses(batch, movies, model, known).write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    writer = (requests.writeStream.foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint or f"{out_dir}/_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def run_recommend_stream(spark: SparkSession, request_dir: str, movies: DataFrame, model: Model,
                         out_dir: str, checkpoint: str | None = None) -> DataFrame:
    """Process every request file present now, then read back all responses (none, if no file has come yet)."""
    q = start_recommend_stream(spark, request_dir, movies, model, out_dir, checkpoint, available_now=True)
    q.awaitTermination()
    nothing = recommend_responses(spark.createDataFrame([], REQUEST_SCHEMA), movies, model).withColumn("batch_id", F.lit(0))
    try:
        return spark.read.schema(nothing.schema).parquet(out_dir)
    except AnalysisException:  # no batch yet
        return nothing
