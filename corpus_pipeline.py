"""From raw documents to packed training sequences: five stages, each one operator of cinerank.llm.

Each stage takes (spark, docs, sf_dir), docs being what its predecessor wrote, and returns
a DataFrame that is written as Parquet for the next. All but the last return the columns of docs.
Rows are told apart by the file and row that hold them, so repeated identifiers (the mix
repeats documents), null identifiers and wholly equal rows are kept apart.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm.common import SPACE, free_name, stored, table, with_locator, written
from cinerank.llm.exact_dedup import exact_dedup
from cinerank.llm.lang_id import held_out, learn
from cinerank.llm.mixing import mix
from cinerank.llm.packing import pack_documents
from cinerank.llm.simhash_dedup import simhash_dedup


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    file, row = free_name(docs, "__file"), free_name(docs, "__row")
    located = with_locator(docs, "*", file=file, row=row)
    return located.join(dropped.select(F.col("_file").alias(file), F.col("_row").alias(row)), [file, row], "left_anti").drop(file, row)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in none of the languages of ``docs``: null texts, texts without a letter, and texts of 32 or more
    characters (10 of them different) whose cosine with the nearest language is no more than chance gives."""
    model = learn(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    if not model.langs:  # nothing to learn from, nothing to reject by
        return docs
    found = free_name(docs, "__lang")
    return docs.withColumn(found, model.predict(F.col("text"))).where(~model.rejects(F.col("text"), F.col(found))).drop(found)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays."""
    docs = stored(docs)
    return _without(docs, exact_dedup(docs).where("not kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays."""
    docs = stored(docs)
    return _without(docs, simhash_dedup(docs, shingle=3, radius=2).where("not kept"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document and epoch of the mix, up to three: the words taken, or the text as it
    is where all of them are. Documents of which nothing is taken go."""
    docs = stored(docs)
    file, row, parts, size = (free_name(docs, c) for c in ("__file", "__row", "__parts", "__taken"))
    taken = mix(docs).placements.groupBy(F.col("_file").alias(file), F.col("_row").alias(row), "epoch").agg(
        F.sort_array(F.collect_list(F.struct("from", "length"))).alias(parts), F.sum("length").alias(size))
    taken = taken.drop("epoch")
    words = F.split(F.btrim(F.col("text"), F.lit(" \t\n\x0b\f\r")), f"{SPACE}+")
    # The outer array makes the words once per row, not once per part.
    some = F.transform(F.array(words), lambda w: F.when(F.size(w) == F.col(size), F.col("text")).otherwise(F.array_join(
        F.flatten(F.transform(parts, lambda p: F.slice(w, (p["from"] + 1).cast("int"), p["length"].cast("int")))), " ")))[0]
    mixed = with_locator(docs, "*", file=file, row=row).join(taken, [file, row]).withColumn("text", some)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and offset; a document that the mix
    repeats is packed once per repeat."""
    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language_id", identify_language), ("exact_dedup", drop_exact_copies), ("simhash_dedup", drop_near_copies),
          ("source_mixing", mix_sources), ("best_fit_packing", pack_sequences)]

#: SQL can't express the learned language model, SimHash's XXH64 or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
