"""Quality rules by repetition coverage.

For every text, the share of its word characters that lie inside repeated n-grams (runs of 5, 6, ... 10
words that occur twice or more in the text, first occurrence included) and inside repeated lines (lines with
a word that equal an earlier line). Words are hashed to 64 bits, and a rolling polynomial extends the hash of
n words to that of n + 1, all in numpy over blocks of many texts. An n+1-gram repeats only where its
first n words do, so after the shortest length only repeated places are looked at.

A text is judged alone: no shuffle, nothing grows with the table. A text is read in parts of ``BLOCK`` bytes; what
stays in memory is about 60 bytes for each of its words. Equal 64-bit hashes count as equal n-grams (for a text
of a million words the chance of one false repeat is 3e-8).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .word_hashes import MIX, mixed, parts, word_hashes

BLOCK = 1 << 20
BASE = np.uint64(0x2545F4914F6CDD1D)
SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True
#: n-gram length -> largest percentage of word characters inside repeated ones.
NGRAM_LIMITS = {5: 30, 6: 29, 7: 28, 8: 27, 9: 26, 10: 25}
LINE_LIMIT = 20


def _points(data: bytes) -> np.ndarray:
    """1 where a code point starts."""
    return (np.frombuffer(data, np.uint8) & 0xC0) != 0x80


def _measured(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, code points) of each word."""
    words, first = word_hashes(data)
    if not len(words):
        return words, first, first
    space = np.isin(np.frombuffer(data, np.uint8), (32, 9, 10, 11, 12, 13))
    return words, first, np.add.reduceat((_points(data) & ~space).astype(np.int64), first)


def word_table(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, code points) of each word of one text of any length."""
    found = [_measured(part) for _, part in parts(text, 0, BLOCK)]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[2] for f in found])


def repeated_lines(text: bytes) -> tuple[int, list[bytes]]:
    """How many lines with a word equal an earlier line, and those lines."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\f\r")]
    if len(set(lines)) == len(lines):
        return 0, []
    seen, again = set(), []
    for x in lines:
        if x in seen:
            again.append(x)
        seen.add(x)
    return len(again), again


def coverage(words: np.ndarray, doc: np.ndarray, lengths: tuple[int, ...]) -> Iterator[np.ndarray]:
    """For each of ``lengths`` (rising): which words lie in an n-gram found twice or more in their own text.
    ``words`` are the hashes of many texts in a row, ``doc`` (not falling) tells the texts apart."""
    m = len(words)
    roll, have, at = words.copy(), 1, np.arange(m)  # roll[k]: hash of ``have`` words from at[k] on
    for n in lengths:
        while have < n:
            roll = roll * BASE
            fits = at + have < m
            roll[fits] += words[at[fits] + have]
            have += 1
        inside = at + n <= m
        inside[inside] &= doc[at[inside]] == doc[at[inside] + n - 1]
        at, roll = at[inside], roll[inside]
        key = mixed(roll, doc[at].astype(np.uint64) + MIX)
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at, roll = at[twice], roll[twice]
        edge = np.zeros(m + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + n, -1)
        yield np.cumsum(edge[:m]) > 0


def _block(texts: list[bytes], lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Columns n_words, word_chars, n_symbols, n_dup_lines, dup_line_chars, n_repeat_words (first length), then
    the covered characters of each length, for the texts of one block."""
    n = len(texts)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    if n == 1:
        words, chars = word_table(texts[0])
        doc = np.zeros(len(words), np.int64)
        symbols = np.array([sum(texts[0].count(bytes([s])) for s in SYMBOLS)])
    else:
        data = b"\n".join(texts)
        words, first, chars = _measured(data)
        doc = np.searchsorted(starts, first, "right") - 1
        marks = np.flatnonzero(IS_SYMBOL[np.frombuffer(data, np.uint8)])
        symbols = np.bincount(np.searchsorted(starts, marks, "right") - 1, minlength=n)
    bounds = np.searchsorted(doc, np.arange(n + 1))

    def per_doc(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    lines = [repeated_lines(t) for t in texts]
    out = [np.diff(bounds), per_doc(chars), symbols, np.array([k for k, _ in lines]),
           np.array([sum(int(word_table(x)[1].sum()) for x in again) for _, again in lines])]
    covered = []
    for k, mask in enumerate(coverage(words, doc, lengths)):
        if k == 0:
            out.append(per_doc(mask))
        covered.append(per_doc(np.where(mask, chars, 0)))
    return out + covered


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram_limits: dict[int, int] | None = None,
                     line_limit: int = LINE_LIMIT, least_words: int = 10, most_repeat_words: int = 20) -> DataFrame:
    """One row per row of ``docs``: (id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    dup_line_chars, dup_chars_<n> for each length, base_failed, kept).

    The shortest length of ``ngram_limits`` (percentages by n-gram length) gives n_repeat_words. base_failed: fewer than ``least_words`` words, or
    over ``most_repeat_words`` percent of them in repeated n-grams of that length. kept: not base_failed, and no length covers more than its
    limit of the word characters, nor the repeated lines more than ``line_limit`` percent.
    A null or blank text has no words and fails. Texts shorter than an n-gram repeat nothing. Null ids and repeated rows come
    back as they came; other columns are ignored; an empty table gives an empty result.
    """
    limits = dict(sorted((ngram_limits or NGRAM_LIMITS).items()))
    lengths = tuple(limits)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "dup_line_chars", "n_repeat_words", *(f"dup_chars_{n}" for n in lengths)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < BLOCK):
                    size += len(texts[end])
                    end += 1
                cols = _block(texts[at:end], lengths)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), *(pa.array(c, pa.int64()) for c in cols)], ["_id", *names])
                at = end

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.mapInArrow(measure, f"_id {kind}, " + ", ".join(f"{x} long" for x in names))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeat_words * F.col("n_words"))
    within = 100 * F.col("dup_line_chars") <= line_limit * F.col("word_chars")
    for n, most in limits.items():
        within &= 100 * F.col(f"dup_chars_{n}") <= most * F.col("word_chars")
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(F.col("_id").alias(id_col), *first, failed.alias("base_failed"), (~failed & within).alias("kept"),
                       *[x for x in names if x not in first])
