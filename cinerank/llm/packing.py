"""Best-fit packing with certified bin counts.

Documents become token ids plus an end id; longer ones than a sequence are cut into pieces. The
pieces are dealt to partitions of about ``items_per_partition`` by hash and each partition
is packed best-fit decreasing. Dual feasible functions give a lower bound of its bin count:
a partition that reaches the bound is certified and done. Partitions with a gap exchange
documents: their worst filled bins (and, on later tries, other bins) go into one pool, which is dealt
again to fewer partitions and packed best-fit decreasing; the new bins are taken if they are
fewer than those given up. What a partition keeps is judged anew by its own bound and takes part in the
next exchange if a gap is left. This goes on until no gap is left or ``tries`` exchanges in a row
win nothing. A task holds the sizes of one partition; the driver sees sums only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, with_locator, written

PIECE = "doc_id long, _file long, _row long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECE + ", round int, part long, bin int, offset long, free int, gap int, worst boolean"


def tokenise(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of each input row: doc_id, its locator, piece, start, length, ids_crc32
    (and the ids themselves). Null counts as empty: one piece, the end id alone. ``tokenizer`` is a
    file of the ``tokenizers`` library that every worker can read."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from .word_tokens import shared
        words = shared(tokenizer)
        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.iloc[i:i + 1024]
                out = []
                for row, ids in zip(zip(part["doc_id"], part["_file"], part["_row"]), words.encode(part["text"].tolist())):
                    ids = np.append(ids, np.int32(end_id)).astype("<u4")
                    for n, start in enumerate(range(0, len(ids), capacity)):
                        cut = ids[start:start + capacity]
                        out.append((*row, n, start, len(cut), zlib.crc32(cut.tobytes()), *([cut.astype(np.int64)] if with_ids else [])))
                yield pd.DataFrame(out, columns=[*(c.split()[0] for c in PIECE.split(", ")), *(["ids"] if with_ids else [])]).astype({"doc_id": "Int64"})

    located = with_locator(stored(docs), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return located.mapInPandas(run, PIECE + (", ids array<long>" if with_ids else ""))


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The least number of bins that dual feasible functions prove necessary."""
    if not len(sizes):
        return 0
    n = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((n * x).sum()) // capacity)
    # Sizes over capacity - t count as whole bins, sizes under t as nothing.
    mass, count = np.cumsum(n * x), np.cumsum(n)
    t = np.arange(1, capacity // 2 + 1)
    whole = count[-1] - count[capacity - t]
    middle = mass[capacity - t] - mass[t - 1]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    # (k + 1) x / capacity rounded down, unless it is whole.
    for k in range(1, 33):
        scaled = np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((n * scaled).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the space left in each bin. ``sizes`` fall."""
    bins, offsets, left = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0  # bit s is set if an open bin has s left
    for i, size in enumerate(sizes.tolist()):
        fits = spaces >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            b = open_bins[space].pop()
            if not open_bins[space]:
                spaces &= ~(1 << space)
        else:
            b, space = len(left), capacity
            left.append(capacity)
        bins[i], offsets[i] = b, capacity - space
        left[b] = space = space - size
        if space:
            open_bins[space].append(b)
            spaces |= 1 << space
    return bins, offsets, np.array(left, np.int64)


FIELDS = [c.split()[0] for c in PIECE.split(", ")]


def _judged(sizes: np.ndarray, left: np.ndarray, capacity: int, give_up: float) -> tuple[int, np.ndarray]:
    """Bins over the lower bound of ``sizes``, and whether each bin, with ``left`` space, is among the worst filled."""
    worst = np.zeros(len(left), bool)
    order = np.argsort(-left, kind="stable")[:int(np.ceil(give_up * len(left)))]
    worst[order[left[order] > 0]] = True
    return len(left) - lower_bound(sizes, capacity), worst


def _packed(items: DataFrame, turn: int, capacity: int, items_per_partition: int, give_up: float) -> DataFrame:
    parts = max(1, -(-items.count() // items_per_partition))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "_h", *FIELDS], ascending=[False] + [True] * (1 + len(FIELDS)), ignore_index=True)
        sizes = group["length"].to_numpy()
        bins, offsets, left = best_fit_decreasing(sizes, capacity)
        gap, worst = _judged(sizes, left, capacity, give_up)
        return group[[*FIELDS, "part"]].assign(round=turn, bin=bins, offset=offsets, free=left[bins], gap=gap, worst=worst[bins])

    dealt = items.select(*FIELDS).withColumn("_h", F.xxhash64(F.lit(turn), "doc_id", "piece", "_row", "ids_crc32"))
    dealt = dealt.withColumn("part", F.pmod("_h", F.lit(parts)))
    return written(dealt.groupBy("part").applyInPandas(run, PLACED), f"packing-{turn}")


def _kept(rest: DataFrame, capacity: int, give_up: float) -> DataFrame:
    """Partitions without the bins they gave up: gap and worst bins of what is left."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        bins, first, which = np.unique(group["bin"].to_numpy(), return_index=True, return_inverse=True)
        gap, worst = _judged(group["length"].to_numpy(), group["free"].to_numpy()[first], capacity, give_up)
        return group.assign(gap=gap, worst=worst[which])

    return rest.groupBy("round", "part").applyInPandas(run, PLACED)


def _bins(placed: DataFrame) -> int:
    return placed.where("offset = 0").count()


def pack(pieces: DataFrame, capacity: int = 2048, items_per_partition: int = 65536, give_up: float = 0.25, tries: int = 2) -> DataFrame:
    """Adds sequence_id and offset to rows of ``PIECE`` (lengths 1 to ``capacity``), and whether the bins that the
    row's partition has now reach their lower bound (certified). Rows that repeat are packed as often as they come."""
    current = _packed(written(pieces, "packing-pieces"), 0, capacity, items_per_partition, give_up)
    done, failed, turn = [], 0, 0
    while failed < tries:
        released = F.col("worst")
        if failed:  # another mixture: worst bins with a third of the rest
            released = released | (F.pmod(F.xxhash64("part", "bin", F.lit(turn)), F.lit(3)) == 0)
        pool = current.where((F.col("gap") > 0) & released)
        before = _bins(pool)
        if not before:
            break
        turn += 1
        again = _packed(pool, turn, capacity, items_per_partition, give_up)
        if _bins(again) < before:
            done.append(current.where("gap <= 0"))
            rest = _kept(current.where((F.col("gap") > 0) & ~released), capacity, give_up)
            current, failed = written(again.unionByName(rest), f"packing-{turn}-kept"), 0
        else:
            failed += 1
    out = current
    for x in done:
        out = out.unionByName(x)
    # Up to 2^24 bins of a partition, 2^26 partitions, 2^14 rounds.
    sequence = F.shiftleft(F.col("round").cast("long"), 50) + F.shiftleft("part", 24) + F.col("bin")
    return out.withColumn("sequence_id", sequence).withColumn("certified", F.col("gap") <= 0).drop(
        "round", "part", "bin", "free", "gap", "worst")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, **how) -> DataFrame:
    """Packs ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens: ``pack`` of ``tokenise``.

    Null texts count as empty. Repeated rows are packed as often as they come (locator columns tell
    them apart). Other columns are ignored; an empty table gives an empty result."""
    return pack(tokenise(docs, tokenizer, capacity, end_id), capacity, **how)
