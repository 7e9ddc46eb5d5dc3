"""Removes passages of ``window`` words or more that occur again, by level-wise doubling.

The lengths of the levels double up to ``window``: 18 and 35 words, or 9, 18 and 35 where the first level starts
lower. Each level looks only at windows that content selects: of its windows inside each whole
window the one with the smallest hash. Equal whole windows select the same shorter window at the same
place, so a whole window can occur again only if its shorter windows do. Those repeated alone are
extended to twice their length: the next level looks only inside whole windows whose shorter window is
repeated. The last level hashes whole windows (two halves that overlap by at most one word), and those
that occur again are the result. A longer window can't cover a word that its parts don't, so the
levels end there, or at the first that leaves no candidate: then nothing is removed.

Skew: documents with equal text count as one (with at least ``window`` words, every copy goes);
what occurs twice within a block of texts is settled there, and one row stands for it in the
shuffle, so a passage in a third of all documents costs a row per block. Rows are joined by
the locator of a document, which no two share. Texts go by 64 bits of hash; those of which a second hash shows that
they share them without being equal (a few at 10^10 documents) go by that second hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, with_locator, written
from .word_hashes import mixed, parts, run_hashes, sliding_min, word_hashes

BLOCK = 1 << 21
LOW = np.uint64(0xFFFFFFFF)
SHORT = "key long, text long, place long, settled int"
WHOLE = "key long, more int, text long, place long, n int, settled int"


class _Block:
    """Texts one after the other: word hashes, and for each word its part, number and text."""

    def __init__(self, rows: list[tuple[int, int, bytes]], window: int, length: int):
        sizes = [len(b) + 1 for _, _, b in rows]
        self.words, first = word_hashes(b"\n".join([b for _, _, b in rows]))
        ends = np.searchsorted(first, np.cumsum(sizes))
        count = np.diff(ends, prepend=0)
        self.part = np.repeat(np.arange(len(rows)), count)
        self.number = np.arange(len(self.words)) - np.repeat(ends - count, count) + np.repeat([w for _, w, _ in rows], count)
        self.text = np.array([t for t, _, _ in rows], np.int64)[self.part]
        self.short = run_hashes(self.words, length)
        n = max(0, len(self.words) - window + 1)
        self.whole = np.flatnonzero(self.part[:n] == self.part[window - 1:]) if n else np.empty(0, np.int64)
        # The chosen shorter window: smallest upper half of the hash, then leftmost.
        at = (self.short & ~LOW) | np.arange(len(self.short), dtype=np.uint64)
        self.chosen = (sliding_min(at, window - length + 1)[self.whole] & LOW).astype(np.int64)

    def alive(self, places: list[np.ndarray]) -> np.ndarray:
        """The whole windows whose chosen shorter window is among the repeated ``places`` of its text (by part)."""
        found = np.zeros(len(self.words), bool)
        ends = np.cumsum(np.bincount(self.part, minlength=len(places)))
        for part, at in enumerate(places):
            begin, end = (ends[part - 1] if part else 0), ends[part]
            if begin < end:
                at = at - self.number[begin] + begin
                found[at[(at >= begin) & (at < end)]] = True
        return found[self.chosen]


def _blocks(batch: pd.DataFrame, window: int, *lengths: int) -> Iterator[tuple]:
    """Blocks of whole texts or parts of long ones, with the rows of the batch they come from, one per length of the shorter windows."""
    rows, of, size = [], [], 0
    for i, (name, text) in enumerate(zip(batch["text_key"], batch["text"])):
        for word, part in parts(bytes(text or b""), window - 1, BLOCK):
            if rows and size + len(part) > BLOCK:
                yield of, *(_Block(rows, window, n) for n in lengths)
                rows, of, size = [], [], 0
            rows.append((name, word, part)), of.append(i)
            size += len(part)
    if rows:
        yield of, *(_Block(rows, window, n) for n in lengths)


def _twice(keys: np.ndarray, text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (key, text, place) rows: the distinct ones, and whether each one's key has another."""
    order = np.lexsort((place, text, keys))
    k, t, p = keys[order], text[order], place[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1]) | (p[1:] != p[:-1])
    order, k = order[fresh], k[fresh]
    again = np.zeros(len(k), bool)
    if len(k) > 1:
        same = k[1:] == k[:-1]
        again[1:] |= same
        again[:-1] |= same
    return order, again


def _level(window: int, before: int | None, length: int) -> Callable:
    """The chosen windows of ``length`` words, at levels after the first only inside whole windows whose chosen window of
    ``before`` words is repeated (``places``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = None if before is None else [np.asarray(x, np.int64) for x in batch["places"]]
            for of, *blocks in _blocks(batch, window, *([] if before is None else [before]), length):
                b = blocks[-1]
                at = np.unique(b.chosen if before is None else b.chosen[blocks[0].alive([found[i] for i in of])])
                if not len(at):
                    continue
                key, text, place = b.short[at].view(np.int64), b.text[at], b.number[at]
                rows, again = _twice(key, text, place)
                key, text, place = key[rows], text[rows], place[rows]
                lead = again.copy()  # one row stands for those that are settled here
                lead[1:] &= key[1:] != key[:-1]
                spread = mixed(text.view(np.uint64), place.astype(np.uint64)).view(np.int64)
                yield pd.DataFrame({"key": np.concatenate([np.where(again, spread, key), key[lead]]),
                                    "text": np.concatenate([text, text[lead]]), "place": np.concatenate([place, place[lead]]),
                                    "settled": np.concatenate([again.astype(np.int32), np.full(lead.sum(), 2, np.int32)])})
    return run


def _whole_windows(window: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        half = -(-window // 2)
        for batch in batches:
            found = [np.asarray(x, np.int64) for x in batch["places"]]
            for of, b in _blocks(batch, window, half):
                p = b.whole[b.alive([found[i] for i in of])]
                if not len(p):
                    continue
                left, right = b.short[p], b.short[p + window - half]
                key = mixed(left, right).view(np.int64)
                more = (mixed(right, left) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                text, place = b.text[p], b.number[p]
                rows, again = _twice(key, text, place)
                lead = again.copy()
                lead[1:] &= key[rows][1:] != key[rows][:-1]
                once, lead = rows[~again], rows[lead]
                yield pd.DataFrame({"key": np.concatenate([key[once], key[lead]]), "more": np.concatenate([more[once], more[lead]]),
                                    "text": np.concatenate([text[once], text[lead]]), "place": np.concatenate([place[once], place[lead]]),
                                    "n": np.int32(1), "settled": np.repeat(np.array([0, 2], np.int32), [len(once), len(lead)])})
                # Settled windows as runs.
                s = np.sort(rows[again])
                if len(s):
                    text, place = text[s], place[s]
                    cut = np.flatnonzero((text[1:] != text[:-1]) | (place[1:] != place[:-1] + 1)) + 1
                    begin = np.concatenate([[0], cut])
                    yield pd.DataFrame({"key": mixed(text[begin].view(np.uint64), place[begin].astype(np.uint64)).view(np.int64),
                                        "more": np.int32(0), "text": text[begin], "place": place[begin],
                                        "n": np.diff(np.append(begin, len(s))).astype(np.int32), "settled": np.int32(1)})
    return run


def _repeated(rows: DataFrame, *key: str) -> DataFrame:
    """Rows settled where they were found, and rows whose key occurs at another text or place."""
    name = F.xxhash64("text", "place")
    group = Window.partitionBy(*key)
    return rows.withColumn("_low", F.min(name).over(group)).withColumn("_high", F.max(name).over(group)).where(
        "settled = 1 or (settled = 0 and _low <> _high)")


def lengths(window: int, first: int) -> list[int]:
    """Lengths of the shorter windows: ``window`` halved, and again while the result is at least ``first``."""
    out = [-(-window // 2)]
    while out[0] > 1 and -(-out[0] // 2) >= first:
        out.insert(0, -(-out[0] // 2))
    return out


def _text_keys(text: Column) -> tuple[Column, Column]:
    """Two hashes of a text: the first names it, the second tells texts apart that share the first."""
    return F.xxhash64(text, F.length(text)), F.xxhash64(F.lit(1), text)


def repeated_spans(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", first: int | None = None) -> DataFrame:
    """One row per input row: (doc_id, _file, _row, whole boolean, spans): the windows that occur again.

    ``whole`` marks texts of which there is another copy (all their windows occur again); otherwise
    ``spans`` has the starts and numbers of consecutive such windows, each start * 2^32 + number, in any
    order, or is null. ``first`` is the least length of a level's windows (default: half of ``window``, one level before
    the last); lower ones add levels, each of which reads its candidates' texts once more."""
    docs = stored(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    key, second = _text_keys(text)
    texts = written(with_locator(docs, F.col(id_col).cast("long").alias("doc_id"), key.alias("text_key"), second.alias("second")), "substring-texts")
    pairs = texts.groupBy("text_key", "second").agg(F.count("*").alias("copies"), F.min(F.struct("_file", "_row")).alias("first"))
    pairs = written(pairs, "substring-copies")
    shared = written(pairs.groupBy("text_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("text_key").alias("shared")), "substring-shared")
    bodies = with_locator(docs, key.alias("text_key"), second.alias("second"), text.cast("binary").alias("text"))
    if not shared.isEmpty():  # different texts with one key
        def renamed(df):
            return df.join(shared, F.col("text_key") == F.col("shared"), "left").withColumn(
                "text_key", F.when(F.col("shared").isNull(), F.col("text_key")).otherwise(F.col("second"))).drop("shared")
        texts, pairs, bodies = renamed(texts), renamed(pairs), renamed(bodies)
    copies = pairs.drop("second")

    alive, before = bodies.select("text_key", "text"), None
    for n in lengths(window, first or window):
        rows = alive.mapInPandas(_level(window, before, n), SHORT)
        found = _repeated(rows, "key").groupBy("text").agg(F.collect_set("place").alias("places"))
        found = written(found.join(copies, found["text"] == copies["text_key"]).select("first._file", "first._row", "places"), f"substring-level{n}")
        alive = bodies.join(found, ["_file", "_row"]).select("text_key", "text", "places")
        if found.isEmpty():
            alive = alive.where(F.lit(False))
            break
        before = n
    whole = alive.mapInPandas(_whole_windows(window), WHOLE)
    spans = _repeated(whole, "key", "more").groupBy("text").agg(
        F.collect_list(F.shiftleft("place", 32) + F.col("n")).alias("spans"))
    spans = spans.join(copies.where("copies = 1"), spans["text"] == copies["text_key"]).select("first._file", "first._row", "spans")
    many = texts.join(copies.where("copies > 1").select("text_key"), "text_key", "left_semi").select(
        "_file", "_row", F.lit(None).cast("array<long>").alias("spans"), F.lit(True).alias("whole"))
    found = written(spans.withColumn("whole", F.lit(False)).unionByName(many), "substring-spans")
    return texts.join(found, ["_file", "_row"], "left").select("doc_id", "_file", "_row", F.coalesce("whole", F.lit(False)).alias("whole"), "spans")


def covered(n_words: int, window: int, whole: bool, spans) -> np.ndarray:
    """Whether each word is covered by a window that occurs again."""
    if whole:
        return np.full(n_words, n_words >= window)
    steps = np.zeros(n_words + 1, np.int64)
    if spans is not None and len(spans):
        s = np.asarray(spans, np.int64)
        first, n = s >> 32, s & 0xFFFFFFFF
        np.add.at(steps, first, 1)
        np.add.at(steps, first + n + window - 1, -1)
    return np.cumsum(steps[:-1]) > 0


def substring_dedup(docs: DataFrame, window: int = 35, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text",
                    first: int | None = None) -> DataFrame:
    """One row per input row: (id_col, n_words, n_removed, kept_sha256[, kept_text]).

    Words are [^\x20\x09-\x0D]+, unchanged; a null text has none. Each word covered by a window of
    ``window`` words that also starts anywhere else, in the same document or another, is removed, judged on the
    input; kept words are joined by one space. Repeated rows are copies of each other. Other columns are
    ignored; an empty table gives an empty result. Windows are equal when 96 bits of hash agree. ``first``: see ``repeated_spans``.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, whole, spans in zip(batch["doc_id"], batch["text"], batch["whole"], batch["spans"]):
                words = bytes(text or b"").split()
                gone = covered(len(words), window, whole, spans)
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words)
                out.append((doc, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), *([kept.decode("utf-8", "replace")] if with_text else [])))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])]).astype({"doc_id": "Int64"})

    docs = stored(docs)
    found = repeated_spans(docs, window, id_col, text_col, first).where("whole or spans is not null").select("_file", "_row", "whole", "spans")
    body = with_locator(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    joined = body.join(found, ["_file", "_row"], "left").select("doc_id", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return joined.mapInPandas(run, schema).withColumnRenamed("doc_id", id_col)
