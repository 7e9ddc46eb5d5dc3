"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. The vector of
an n-gram binds its letters' vectors, each permuted (rotated) by its place: the
elementwise product. A text's vector bundles (adds) the vectors of its n-grams; a
language's prototype bundles the unit vectors of its training documents. A document
is compared with every prototype by cosine.

Whole texts are read, ``chunk`` characters at a time. n-grams that repeat are counted
first, so bundling a block of texts is one matrix product of counts and n-gram vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For every code point the code point of its lower-case letter, or 32 if it is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _letter(code: int, dim: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, int(code)])).integers(0, 2, dim).astype(np.float32) * 2 - 1


def _distinct(x: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with its inverse for numbers from 0 to ``top``: by a table where that is small, without sorting."""
    if top > 1 << 22:
        return np.unique(x, return_inverse=True)
    seen = np.zeros(top + 1, bool)
    seen[x] = True
    found = np.flatnonzero(seen)
    at = np.empty(top + 1, np.int32)
    at[found] = np.arange(len(found), dtype=np.int32)
    return found, at[x]


class Bundler:
    """Turns texts into bundled n-gram vectors; keeps the letter vectors it has drawn."""

    def __init__(self, dim: int, n: int, seed: int, chunk: int = 1 << 20):
        self.dim, self.n, self.seed, self.chunk = dim, n, seed, chunk
        self.letters: dict[int, np.ndarray] = {}

    def _grams(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of n-grams given as rows of code points."""
        alphabet, at = np.unique(codes, return_inverse=True)
        at = at.reshape(codes.shape)
        for c in alphabet.tolist():
            if c not in self.letters:
                self.letters[c] = _letter(c, self.dim, self.seed)
        base = np.stack([self.letters[c] for c in alphabet.tolist()])
        out = np.ones((len(codes), self.dim), np.float32)
        for place in range(self.n):
            out *= np.roll(base, self.n - 1 - place, axis=1)[at[:, place]]
        return out

    def _block(self, parts: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
        """Adds the n-grams of each part (row of out, code points) to its row."""
        codes = np.concatenate([p for _, p in parts])
        rows = np.repeat([i for i, _ in parts], [len(p) for _, p in parts])
        alphabet, at = _distinct(codes, int(codes.max()))
        key = np.zeros(len(codes) - self.n + 1, np.int64)
        for place in range(self.n):
            key = key * len(alphabet) + at[place:len(key) + place]
        whole = np.ones(len(key), bool)
        ends = np.cumsum([len(p) for _, p in parts])[:-1]
        for back in range(1, self.n):  # n-grams that would run into the next text
            whole[(ends - back)[(ends - back >= 0) & (ends - back < len(key))]] = False
        blank = np.flatnonzero(alphabet == 32)
        if len(blank):  # n-grams across two words are kept; pure blanks say nothing
            whole &= ~(key == sum(int(blank[0]) * len(alphabet) ** i for i in range(self.n)))
        key, rows = key[whole], rows[:len(whole)][whole]
        if not len(key):
            return
        found, gram = _distinct(key, len(alphabet) ** self.n - 1)
        spelled = np.stack([alphabet[found // len(alphabet) ** (self.n - 1 - p) % len(alphabet)] for p in range(self.n)], axis=1)
        used, row = _distinct(rows, int(rows[-1]))
        step = 8192
        for i in range(0, len(found), step):  # bounded: step n-gram vectors at a time
            here = (gram >= i) & (gram < i + step)
            wide = min(step, len(found) - i)
            counts = np.bincount(row[here] * wide + gram[here] - i, minlength=len(used) * wide).reshape(len(used), wide)
            out[used] += counts.astype(np.float32) @ self._grams(spelled[i:i + wide])

    def vectors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(a row of float32 per text, whether the text has a letter)."""
        out, has = np.zeros((len(texts), self.dim), np.float32), np.zeros(len(texts), bool)
        fold, parts, size = _folded(), [], 0
        for i, text in enumerate(texts):
            text = text or ""
            for at in range(0, len(text), self.chunk):
                piece = text[max(0, at - self.n + 1):at + self.chunk]
                codes = fold[np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)]
                letter = codes != 32
                if not letter.any():
                    continue
                has[i] = True
                keep = letter | np.concatenate([[True], letter[:-1]])  # runs of other characters count as one blank
                parts.append((i, np.concatenate([[np.uint32(32)], codes[keep], [np.uint32(32)]])))
                size += len(piece)
                if size >= self.chunk // 2:
                    self._block(parts, out)
                    parts, size = [], 0
        if parts:
            self._block(parts, out)
        return out, has


@dataclass
class LanguageModel:
    """Prototypes: one unit vector per language (languages x dim numbers, whatever the input)."""
    langs: list[str]
    prototypes: np.ndarray
    dim: int
    n: int
    seed: int

    def predict(self, text: Column) -> Column:
        """struct(lang, score): the language whose prototype has the highest cosine, and that cosine
        (0 if negative); ``und`` and 0 for null, for texts without a letter, and if nothing was learned."""
        langs, prototypes, dim, n, seed = np.array(self.langs, dtype=object), self.prototypes, self.dim, self.n, self.seed

        @F.pandas_udf("lang string, score double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            bundler = Bundler(dim, n, seed)
            for texts in batches:
                lang, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
                for i in range(0, len(texts) if len(langs) else 0, 1024):
                    v, has = bundler.vectors(texts.iloc[i:i + 1024].tolist())
                    size = np.linalg.norm(v, axis=1)
                    cos = (v @ prototypes.T) / np.maximum(size, 1e-12)[:, None]
                    best = cos.argmax(axis=1)
                    ok = np.flatnonzero(has)
                    lang[i + ok] = langs[best[ok]]
                    score[i + ok] = np.clip(cos[ok, best[ok]], 0, 1)
                yield pd.DataFrame({"lang": lang, "score": score})
        return run(text)


    def rejects(self, text: Column, predicted: Column) -> Column:
        """Whether ``text`` is in none of the languages, ``predicted`` being its prediction: ``und``, or a text of at least
        32 characters, 10 of them different, no nearer to any prototype than two standard deviations of the cosine of
        unrelated random vectors (others have too few n-grams to say so)."""
        by_chance = 2 / self.dim ** 0.5
        return (predicted["lang"] == UNDETERMINED) | (
            (predicted["score"] < by_chance) & (F.length(text) >= 32) & (F.size(F.array_distinct(F.split(text, ""))) >= 10))


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = 1024, n: int = 3,
          seed: int = 42, max_langs: int = 4096) -> LanguageModel:
    """Prototypes from all rows with a non-null language. Each task bundles its rows, so a
    language with most of the rows costs one vector per task; tasks' vectors are added in a
    group-by. More than ``max_langs`` distinct values raise an error (they aren't languages)."""
    def bundled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundler, totals = Bundler(dim, n, seed), {}
        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.iloc[i:i + 1024]
                v, has = bundler.vectors(part["text"].tolist())
                v /= np.maximum(np.linalg.norm(v, axis=1), 1e-12)[:, None]
                langs = part["lang"].to_numpy()
                for lang in set(langs[has]):
                    totals[lang] = totals.get(lang, 0) + v[(langs == lang) & has].sum(axis=0, dtype=np.float64)
        if totals:
            yield pd.DataFrame({"lang": list(totals), "v": [x.tolist() for x in totals.values()]})

    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sums = rows.mapInPandas(bundled, "lang string, v array<double>").select("lang", F.posexplode("v").alias("at", "x"))
    sums = sums.groupBy("lang", "at").agg(F.sum("x").alias("x"))
    found = (sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v"))
             .select("lang", F.transform("v", lambda s: s["x"]).alias("v")).orderBy("lang").limit(max_langs + 1).collect())
    if len(found) > max_langs:
        raise ValueError(f"more than {max_langs} distinct values in {lang_col}")
    v = np.array([r["v"] for r in found], np.float64).reshape(len(found), dim)
    v /= np.maximum(np.linalg.norm(v, axis=1), 1e-12)[:, None]
    return LanguageModel([r["lang"] for r in found], np.round(v, 9).astype(np.float32), dim, n, seed)


def held_out(doc_id: Column) -> Column:
    """Rows that may not be learned from: crc32 of the id as text leaves 2 modulo 4. A null id
    has no remainder and isn't held out, but isn't learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """One row per document: (id_col, held_out, lang_pred, score).

    Learns from rows with a non-null language and id that aren't held out; only the text
    enters a prediction. Null texts and texts without a letter are ``und`` with score 0, as is
    everything if there is nothing to learn from. Repeated rows come back as often as they
    came. Other columns are ignored; an empty table gives an empty result.
    """
    model = learn(docs.where(~held_out(F.col(id_col)) & F.col(id_col).isNotNull()), text_col, lang_col, **how)
    return docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), model.predict(F.col(text_col)).alias("_p")).select(
        id_col, "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))
