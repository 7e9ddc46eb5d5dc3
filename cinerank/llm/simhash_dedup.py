"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are 64 bits: words of the lower-cased (A-Z) text, shingles of
``shingle`` consecutive words, XXH64 (seed 42) of each; a bit is set when it is set
in over half of the shingles' hashes.

Equal fingerprints are grouped first, so copies cost one row. Distinct fingerprints
are dealt to tiles by their population counts: one count for each 16-bit quarter.
Two fingerprints that differ in r bits have counts that differ by at most r in sum,
so a tile is compared only with the tiles whose counts differ by no more than the
radius (at most 41 of 83,521 for radius 2); all other tile pairs are skipped. Tiles
of more than ``block`` fingerprints are split, and each pair of blocks is one work
item: the item's own block is held in numpy, the visiting blocks stream past it and
are compared by exclusive-or and bit count. An item emits stars (one row per linked
fingerprint), never its pairs; the stars are joined up by ``components``.

Nothing is dropped: every pair within the radius meets in exactly one item.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, forest, stored, with_locator, written

QUARTERS, SIDE = 4, 17
LANES = np.uint64(0x0101010101010101)


def bit_totals(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set (bit 0 first)."""
    h = np.concatenate([h, np.zeros(-len(h) % 255, np.uint64)])
    out = np.empty((8, 8), np.int64)
    for s in range(8):  # byte lanes; 255 additions can't overflow one
        lanes = ((h >> np.uint64(s)) & LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        out[:, s] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.ravel()


def fingerprint(text: bytes | None, shingle: int, chunk: int = 1 << 16) -> int:
    """The fingerprint as a signed 64-bit integer; 0 without words. Long texts are hashed
    ``chunk`` shingles at a time."""
    words = (text or b"").lower().split()  # bytes: A-Z and [\x20\x09-\x0D] only
    if not words:
        return 0
    k = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n, totals, digest = len(words) - k + 1, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, chunk):
        j = min(n, i + chunk)
        h = [digest(joined[s:e], 42) for s, e in zip(starts[i:j].tolist(), ends[i + k - 1:j + k - 1].tolist())]
        totals += bit_totals(np.array(h, np.uint64))
    return int(np.packbits(totals * 2 > n, bitorder="little").view(np.int64)[0])


def simhash(text: Column, shingle: int = 3) -> Column:
    """Fingerprint of a text column (long, the 64 bits as they are). Null counts as empty."""
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return run(text.cast("binary"))


def _tile(counts: list[Column]) -> Column:
    return sum((c * SIDE ** i for i, c in enumerate(counts)), F.lit(0)).cast("int")


def _links(items: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by (tile, block, visiting): links of the own block with itself and with
    each visiting fingerprint, as stars."""
    key, own, a, b = None, np.empty(0, np.uint64), [], []

    def compare(left: np.ndarray, right: np.ndarray, same: bool) -> None:
        step = max(1, (1 << 20) // max(1, len(left)))
        for i in range(0, len(right), step):
            part = right[i:i + step]
            r, c = np.nonzero(np.bitwise_count(part[:, None] ^ left[None, :]) <= radius)
            if same:
                r, c = r[c < r + i], c[c < r + i]
            if len(r):
                u, v = forest(part[r].view(np.int64), left[c].view(np.int64))
                a.append(u), b.append(v)

    for batch in items:
        tile, block, visiting = (batch[c].to_numpy() for c in ("tile", "block", "visiting"))
        fp = batch["fp"].to_numpy().view(np.uint64)
        cut = np.flatnonzero((np.diff(tile) != 0) | (np.diff(block) != 0) | (np.diff(visiting) != 0)) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(fp)]):
            if i == j:
                continue
            if key != (tile[i], block[i]):
                key, own = (tile[i], block[i]), np.empty(0, np.uint64)
            part = fp[i:j]
            compare(own, part, False)
            if not visiting[i]:
                compare(part, part, True)
                own = np.concatenate([own, part])
        if a:
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})
            a.clear(), b.clear()


def fingerprint_links(distinct: DataFrame, radius: int = 2, block: int = 4096) -> DataFrame:
    """Links (a long, b long) that connect the fingerprints ``fp`` within ``radius`` bits."""
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(65535))) for i in range(QUARTERS)]
    tiled = written(distinct.select("fp", _tile(counts).alias("tile")), "simhash-tiles")
    # At most 17^4 = 83,521 rows of 8 bytes, whatever the input: safe to broadcast.
    tiles = tiled.groupBy("tile").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    tiles = F.broadcast(written(tiles, "simhash-tile-blocks"))
    own = tiled.join(tiles, "tile").select("tile", "fp", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"))
    steps = [d for d in product(range(-radius, radius + 1), repeat=QUARTERS)
             if sum(map(abs, d)) <= radius and sum(x * SIDE ** i for i, x in enumerate(d)) < 0]
    digits = [F.floor(F.col("tile") / SIDE ** i).cast("int") % SIDE for i in range(QUARTERS)]
    lower = F.array(*[F.when(_all_within(digits, d), F.col("tile") + sum(x * SIDE ** i for i, x in enumerate(d)))
                      for d in steps])
    abroad = own.select("fp", F.explode(F.filter(lower, lambda t: t.isNotNull())).alias("tile")).join(tiles, "tile")
    abroad = abroad.select("tile", "fp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    at_home = own.where("block > 0").select("tile", "fp", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("block"))
    items = own.withColumn("visiting", F.lit(False)).unionByName(
        abroad.unionByName(at_home).withColumn("visiting", F.lit(True)))
    items = items.repartition("tile", "block").sortWithinPartitions("tile", "block", "visiting")
    return items.mapInPandas(lambda it: _links(it, radius), "a long, b long")


def _all_within(digits: list[Column], step: tuple[int, ...]) -> Column:
    ok = F.lit(True)
    for c, x in zip(digits, step):
        if x:
            ok = ok & (c + x).between(0, SIDE - 1)
    return ok


def simhash_dedup(docs: DataFrame, shingle: int = 3, radius: int = 2, block: int = 4096,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id_col, fp long, fingerprint string, component_id long, kept, _file, _row).

    component_id is the smallest id reachable by links of ``radius`` bits or fewer, and kept marks the
    row that stays of each component: the one with that id (the first by locator, if several have it).
    Null or empty texts have fingerprint zero and are linked like any other. Rows that repeat (same
    id or same text) come back as often as they came; a null id never is the smallest one, and a
    component of null ids only has component_id null. Other columns of ``docs`` are ignored. An empty
    table gives an empty result.
    """
    rows = written(with_locator(stored(docs), F.col(id_col).cast("long").alias("doc_id"), simhash(F.col(text_col), shingle).alias("fp")),
                   "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_file", "_row"))
    distinct = written(rows.groupBy("fp").agg(first.alias("least")), "simhash-distinct")
    found = written(components(fingerprint_links(distinct, radius, block), "simhash"), "simhash-components")
    merged = found.join(distinct, found["node"] == distinct["fp"]).groupBy("root").agg(F.min("least").alias("_joint"))
    joint = found.join(merged, "root").select(F.col("node").alias("fp"), "_joint")
    labels = distinct.join(joint, "fp", "left").select("fp", F.coalesce("_joint", "least").alias("_least"))
    kept = (F.col("_file") == F.col("_least._file")) & (F.col("_row") == F.col("_least._row"))
    return rows.join(labels, "fp").select(
        F.col("doc_id").alias(id_col), "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("_least.doc_id").alias("component_id"), kept.alias("kept"), "_file", "_row")
