"""Mixing sources to target weights, with DataFrame functions only.

The words of a source, document after document in a pseudorandom order, are cut into
blocks of ``block`` words. The mix is a number of output shards of block slots:

* targets: sources, ordered by code point (null last), weigh 1, 2, 3 and so on in turn, and
  share the total size by weight; a target stops at ``cap`` times its source's size and what
  is above is shared again by weight (solved at once by sorting sources by cap per weight);
* quota: the number of slots that a source's target takes, the last of them partial: it takes only the
  words of its block that are left of the target;
* draws: each shard draws its multinomial source counts, one hashed uniform number a slot, with
  the quotas' shares as probabilities; summed over all shards a source may be drawn a little too
  often or too seldom, so the surplus of the last shards goes to the sources that fell short, and every
  source ends with exactly its quota;
* indices: the k-th draw of a source, counted over the shards, takes index k modulo the
  source's number of blocks, and a per-source permutation (rank by a keyed hash) maps the
  index to a block: each block is taken once before any is taken twice;
* blocks and slots are joined by (source, index).

Running sums over a source (places of documents, ranks of blocks) are made in two steps, sums
of 4,096 hash buckets and then within each bucket, so a source with a third of all rows is
spread like any other. Sources themselves may be many (hosts): they are numbered by range partitions, sums
over them are made in two steps as well, and a draw looks its source up in a cell of the unit interval that few sources share.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.split import global_position
from .common import SPACE, stored, with_locator, written

BUCKETS, CELLS = 4096, 1024


@dataclass
class Mix:
    """sources: one row per source; documents: one row per input row; placements: one row per
    part of a document in a slot (shard, source, epoch, block, the document, from, length in words)."""
    sources: DataFrame
    documents: DataFrame
    placements: DataFrame


def word_count(text: Column) -> Column:
    """Number of [^\x20\x09-\x0D]+ in the text; null has none."""
    t = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(t) > 0, F.size(F.split(t, f"{SPACE}+"))).otherwise(0).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """From (source, source_size): sid, weight and target. One row per source throughout."""
    ranked = global_position(sizes, [F.col("source").isNull(), F.col("source")], "_at").withColumn("sid", (F.col("_at") - 1).cast("int")).drop("_at")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("sid") % len(weights) + 1)
    ranked = ranked.withColumn("weight", weight.cast("double")).withColumn("most", (cap * F.col("source_size")).cast("double"))
    # The first source, by cap per weight, that isn't stopped sets the level; those before it are stopped.
    sums = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    ranked = global_position(ranked.withColumn("_r", F.col("most") / F.col("weight")), [F.col("_r"), F.col("sid")], "_at")
    bucket = F.floor(F.col("_at") / BUCKETS)
    steps = _running(ranked, bucket, ["_at"], F.col("most"), "_left")
    steps = _running(steps, bucket, ["_at"], F.col("weight"), "_weights")
    level = (F.lit(sums[0]) - (F.col("_left") - F.col("most"))) / (F.lit(sums[1]) - F.col("_weights") + F.col("weight"))
    found = steps.select("_r", "sid", level.alias("_level")).where("_level <= _r").agg(F.min(F.struct("_r", "sid", "_level")).alias("l")).first()["l"]
    return ranked.withColumn("target", F.least("most", F.col("weight") * F.lit(float(found["_level"]) if found else 0.0))).select(
        "source", "sid", "source_size", "weight", "target")


def _running(df: DataFrame, bucket: Column, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the running sum of ``value`` over the whole table, by ``bucket`` and in it by ``order``: one row per bucket is
    added up in one place, and each bucket on its own."""
    df = df.withColumn("_g", bucket).withColumn("_v", value)
    sums = df.groupBy("_g").agg(F.sum("_v").alias("_s"))
    before = sums.select("_g", (F.sum("_s").over(Window.orderBy("_g")) - F.col("_s")).alias("_before"))
    inside = F.sum("_v").over(Window.partitionBy("_g").orderBy(*order))
    return df.join(before, "_g").withColumn(name, F.col("_before") + inside).drop("_g", "_v", "_before")


def _numbers(first: Column, last: Column, chunk: int = 1 << 16) -> tuple[Column, Column]:
    """first..last in two explodes, so that no row holds a long array: explode the first as _c, then the second."""
    return (F.explode(F.sequence(F.floor(first / chunk), F.floor(last / chunk))),
            F.explode(F.sequence(F.greatest(first, F.col("_c") * chunk), F.least(last, (F.col("_c") + 1) * chunk - 1))))


def mix(docs: DataFrame, block: int = 64, slots_per_shard: int = 16384, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3,
        seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    """Mix ``docs``; see the module's text and ``Mix``.

    documents has one row per input row: (id_col, size, source_size, target, taken, _file, _row).
    A null text has size 0; documents without words are never taken. Null is a source of its own
    and comes last. Rows that repeat are documents of their own. Other columns are ignored; an
    empty table gives empty results. Equal input gives an equal mix.
    """
    spark = docs.sparkSession
    rows = written(with_locator(
        stored(docs), F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("_h")), "mix-rows")
    sources = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    n_blocks = F.ceil(F.col("source_size") / block)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - epochs * F.col("source_size")
    rest = F.round(F.coalesce(rest, F.lit(0.0))).cast("long")
    partial = F.ceil(F.col("rest") / block)
    sources = sources.withColumn("n_blocks", n_blocks.cast("long")).withColumn("rest", rest).withColumn("quota", (epochs * n_blocks + partial).cast("long"))
    sources = written(sources.withColumn("last", F.when(F.col("rest") > 0, F.col("rest") - (partial - 1) * block).otherwise(block).cast("long"))
                      .drop("rest"), "mix-sources")
    slots, n_sources = sources.agg(F.coalesce(F.sum("quota"), F.lit(0)).cast("long"), F.count("*")).first()
    # As many cells as sources or more, so that a cell has few sources, and at most some thousands of slots.
    n_cells = min(max(CELLS, 1 << n_sources.bit_length(), 1 << (slots // 4096).bit_length()), (1 << 62) // max(1, slots))

    # Documents' places in their sources, and their parts by block.
    rows = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).select(rows["*"], "sid", "source_size", "target")
    placed = rows.where("size > 0").withColumn("_b", F.pmod("_h", F.lit(BUCKETS)))
    sums = placed.groupBy("sid", "_b").agg(F.sum("size").alias("_s"))
    sums = sums.select("sid", "_b", (F.sum("_s").over(Window.partitionBy("sid").orderBy("_b")) - F.col("_s")).alias("_before"))
    inside = Window.partitionBy("sid", "_b").orderBy("_h", "size", "_file", "_row").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.hint("merge").join(sums, ["sid", "_b"]).withColumn("_start", F.col("_before") + F.sum("size").over(inside) - F.col("size"))
    outer, inner = _numbers(F.floor(F.col("_start") / block), F.floor((F.col("_start") + F.col("size") - 1) / block))
    parts = placed.withColumn("_c", outer).withColumn("block", inner)
    begin = F.greatest(F.col("_start"), F.col("block") * block)
    end = F.least(F.col("_start") + F.col("size"), (F.col("block") + 1) * block)
    parts = parts.select("sid", "block", "doc_id", "_file", "_row", (begin - F.col("_start")).alias("from"), (end - begin).alias("length"),
                         (begin - F.col("block") * block).alias("_at"))

    # The permutation: blocks ranked by a keyed hash, in buckets of its top bits.
    outer, inner = _numbers(F.lit(0).cast("long"), F.col("n_blocks") - 1)
    blocks = sources.where("n_blocks > 0").select("sid", "n_blocks", outer.alias("_c")).repartition("sid", "_c")
    blocks = blocks.select("sid", inner.alias("block")).withColumn("_h", F.xxhash64(F.lit(seed + 1), "sid", "block"))
    blocks = blocks.withColumn("_b", F.shiftrightunsigned("_h", 52))
    sums = blocks.groupBy("sid", "_b").agg(F.count("*").alias("_n"))
    sums = sums.select("sid", "_b", (F.sum("_n").over(Window.partitionBy("sid").orderBy("_b")) - F.col("_n")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("sid", "_b").orderBy("_h", "block")) - 1
    # Sizes of exploded tables are unknown when the plan is made: ask for merge joins, never a broadcast.
    blocks = blocks.hint("merge").join(sums, ["sid", "_b"]).select("sid", "block", (F.col("_before") + rank).alias("index"))

    # Multinomial counts of each shard, found through cells of the unit interval.
    by_sid = F.floor(F.col("sid") / BUCKETS)
    share = _running(sources.where("quota > 0").select("sid", "quota"), by_sid, ["sid"], F.col("quota"), "_hi")
    share = share.withColumn("_lo", F.col("_hi") - F.col("quota"))
    outer, inner = _numbers(F.floor(F.col("_lo") * n_cells / F.lit(max(1, slots))), F.floor((F.col("_hi") - 1) * n_cells / F.lit(max(1, slots))))
    cells = share.withColumn("_c", outer).withColumn("_cell", inner).select("sid", "_lo", "_hi", "_cell")
    u = spark.range(slots).select(F.floor(F.col("id") / slots_per_shard).alias("shard"),
                                  F.pmod(F.xxhash64(F.lit(seed + 2), "id"), F.lit(max(1, slots))).alias("_u"))
    u = u.withColumn("_cell", F.floor(F.col("_u") * n_cells / F.lit(max(1, slots))))
    drawn = u.join(cells, "_cell").where("_u >= _lo and _u < _hi").groupBy("shard", "sid").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = drawn.join(share.select("sid", "quota"), "sid").withColumn("_k", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    drawn = written(drawn.withColumn("_keep", F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("_k")))), "mix-draws")

    # What the last shards drew beyond a quota goes to the sources that fell short, one by one.
    kept = drawn.where("_keep > 0").select("shard", "sid", F.explode(F.sequence("_k", F.col("_k") + F.col("_keep") - 1)).alias("k"))
    over = drawn.where("n > _keep").select("shard", F.col("sid").alias("_s"), (F.col("n") - F.col("_keep")).alias("_n"))
    over = _running(over, F.floor(F.col("shard") / 64), ["shard", "_s"], F.col("_n"), "_hi")
    over = over.select("shard", F.explode(F.sequence(F.col("_hi") - F.col("_n"), F.col("_hi") - 1)).alias("_r"))
    short = share.join(drawn.groupBy("sid").agg(F.sum("_keep").alias("_had")), "sid", "left").fillna(0, ["_had"]).where("_had < quota")
    short = _running(short, by_sid, ["sid"], F.col("quota") - F.col("_had"), "_hi")
    short = short.withColumn("_lo", F.col("_hi") - F.col("quota") + F.col("_had"))
    short = short.select("sid", "_had", "_lo", F.explode(F.sequence("_lo", F.col("_hi") - 1)).alias("_r"))
    filled = over.hint("merge").join(short, "_r").select("shard", "sid", (F.col("_had") + F.col("_r") - F.col("_lo")).alias("k"))
    taken = kept.unionByName(filled).join(sources.select("sid", "source", "n_blocks", "quota", "last"), "sid").select(
        "shard", "sid", "source", F.floor(F.col("k") / F.col("n_blocks")).alias("epoch"), (F.col("k") % F.col("n_blocks")).alias("index"),
        F.when(F.col("k") == F.col("quota") - 1, F.col("last")).otherwise(block).alias("_most"))

    placed = taken.hint("merge").join(blocks, ["sid", "index"]).hint("merge").join(parts.hint("merge"), ["sid", "block"])
    placements = written(placed.where("_at < _most").select(
        "shard", "source", "epoch", "block", "doc_id", "_file", "_row", "from", F.least("length", F.col("_most") - F.col("_at")).alias("length")), "mix-placements")
    total = placements.groupBy("_file", "_row").agg(F.sum("length").alias("taken"))
    documents = rows.join(total, ["_file", "_row"], "left").select(
        F.col("doc_id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "_file", "_row")
    return Mix(sources, documents, placements)
