"""Token ids of texts: what ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives.

The tokenizer library is slow mostly because it normalises and splits every text anew. Under a lower-casing
word BPE file (``LAYOUT``) texts are split in numpy, words that repeat are found by hash and compared
letter by letter, and only words not met before in this worker go to the BPE model. Texts with characters outside
the plain range below (where lower-casing and normalisation are one character to one), and texts that hold
the string of an added token (which becomes that token, as in the library), go through the library as they are.
Under any other file all texts do.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

#: Tab, line ends, ASCII, Latin-1 and Latin Extended-A, without U+00AD and U+0130 (its lower case is two characters).
TOP = 0x180
PLAIN = np.zeros(TOP + 1, bool)
PLAIN[[9, 10, 13, *range(32, 127), *range(0xA1, TOP)]] = True
PLAIN[[0xAD, 0x130]] = False
LOWER = np.array([ord(chr(i).lower()[0]) if PLAIN[i] else 32 for i in range(TOP + 1)], np.uint16)
BLANK, LETTER, NUMBER, SYMBOL = range(4)
KIND = np.array([LETTER if chr(i).isalpha() else NUMBER if chr(i).isnumeric() else SYMBOL if PLAIN[i] and i > 32 else BLANK
                 for i in range(TOP + 1)], np.uint8)
KIND[~PLAIN] = BLANK
#: The settings of the tokenizer files that are split in numpy.
LAYOUT = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>",
              "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}}
_draw = np.random.Generator(np.random.PCG64(7))
WEIGHT = _draw.integers(0, 1 << 63, TOP + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WEIGHT[KIND == BLANK] = 0
STEP = np.uint64(0x9E3779B97F4A7C15)


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _runs(offset: np.ndarray, count: np.ndarray) -> np.ndarray:
    """offset[0], offset[0] + 1, ... (count[0] of them), then offset[1] and so on."""
    ends = np.cumsum(count)
    return np.repeat(offset - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)


class Known:
    """Words with their ids, sorted by hash: hashes, letters and ids in flat arrays."""

    def __init__(self):
        self.sums, self.letters, self.ids = np.empty(0, np.uint64), np.empty(0, np.uint16), np.empty(0, np.int32)
        self.at, self.length, self.id_at, self.count = (np.empty(0, np.int64) for _ in range(4))

    def add(self, sums, words: list[np.ndarray], ids: list[list[int]]) -> None:
        n, count = np.array([len(w) for w in words], np.int64), np.array([len(x) for x in ids], np.int64)
        at = np.concatenate([self.at, len(self.letters) + np.cumsum(n) - n])
        id_at = np.concatenate([self.id_at, len(self.ids) + np.cumsum(count) - count])
        sums, n, count = (np.concatenate(x) for x in ((self.sums, sums), (self.length, n), (self.count, count)))
        self.letters = np.concatenate([self.letters, *words])
        self.ids = np.concatenate([self.ids, np.array([i for x in ids for i in x], np.int32)])
        order = np.argsort(sums)
        self.sums, self.at, self.length, self.id_at, self.count = (x[order] for x in (sums, at, n, id_at, count))

    def find(self, sums, letters, first, length) -> tuple[np.ndarray, np.ndarray]:
        """(whether each word is known, its place): the hash, the length and all letters agree."""
        if not len(self.sums):
            return np.zeros(len(sums), bool), np.zeros(len(sums), np.int64)
        place = np.minimum(np.searchsorted(self.sums, sums), len(self.sums) - 1)
        known = (self.sums[place] == sums) & (self.length[place] == length)
        i = np.flatnonzero(known)
        if len(i):
            same = letters[_runs(first[i], length[i])] == self.letters[_runs(self.at[place[i]], length[i])]
            known[i] = np.logical_and.reduceat(same, np.cumsum(length[i]) - length[i])
        return known, place


class WordTokens:
    """``encode(texts)`` gives an int32 array of ids per text. Keeps up to ``keep`` words' ids."""

    def __init__(self, path: str, keep: int = 500_000, chunk: int = 1 << 19):
        self.full = Tokenizer.from_file(path)
        self.added, self.splits = self._settings()
        self.model, self.letters = self.full.model, byte_letters()
        self.keep, self.chunk = keep, chunk
        self.known, self.recent = Known(), {}  # recent: by hash, until there are enough to merge

    def _settings(self) -> tuple[list[str], bool]:
        """The strings of added tokens, and whether texts can be split here."""
        file = json.loads(self.full.to_str())
        added = file["added_tokens"]
        layout = {k: file[k] for k in LAYOUT}
        layout["model"] = {k: v for k, v in layout["model"].items() if k not in ("vocab", "merges")}
        simple = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"] for t in added)
        return [t["content"] for t in added], layout == LAYOUT and simple and not file["truncation"] and not file["padding"]

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.int32)

    def _unknown(self, sums: np.ndarray, words: list[np.ndarray]) -> list[list[int]]:
        """Ids of words that ``known`` hasn't, from the words met lately or else the model."""
        out = []
        for h, w in zip(sums.tolist(), words):
            got = self.recent.get(h)
            if got is None or not np.array_equal(got[0], w):
                word = w.astype("<u4").tobytes().decode("utf-32-le")
                got = (w, [t.id for t in self.model.tokenize("".join([self.letters[b] for b in word.encode()]))])
                if len(w) < 64:
                    self.recent[h] = got
            out.append(got[1])
        return out

    def _merge(self) -> None:
        if len(self.known.sums) + len(self.recent) > self.keep:
            self.known = Known()
        self.known.add(np.array(list(self.recent), np.uint64), *map(list, zip(*self.recent.values())))
        self.recent = {}

    def _parts(self, text: str) -> list[str]:
        """The text cut at blanks into parts of about ``chunk`` characters (tokens never hold a blank)."""
        out, at = [], 0
        while len(text) - at > self.chunk:
            end = at + self.chunk
            while end < len(text) and text[end] != " ":
                end += 1
            out.append(text[at:end])
            at = end
        out.append(text[at:])
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if not self.splits:
            return [self._library(text or "") for text in texts]
        parts, owner = [], []
        for i, text in enumerate(texts):
            for part in self._parts(text or ""):
                parts.append(part), owner.append(i)
        found, at = [], 0
        while at < len(parts):
            end, size = at, 0
            while end < len(parts) and (end == at or size + len(parts[end]) <= self.chunk):
                size += len(parts[end])
                end += 1
            found += self._block(parts[at:end])
            at = end
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for i, ids in zip(owner, found):
            out[i].append(ids)
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def _block(self, texts: list[str]) -> list[np.ndarray]:
        codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "replace"), np.uint32)
        begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        codes = np.minimum(codes, TOP).astype(np.uint16)
        odd = np.add.reduceat(~PLAIN[codes], begin[:-1]) > 0
        odd |= np.array([any(a in t for a in self.added) for t in texts], bool)
        for i in np.flatnonzero(odd):
            codes[begin[i]:begin[i + 1]] = 10
        out = self._plain(codes, begin)
        if out is None:  # two words with one hash
            return [self._library(t) for t in texts]
        for i in np.flatnonzero(odd):
            out[i] = self._library(texts[i])
        return out

    def _plain(self, codes: np.ndarray, begin: np.ndarray) -> list[np.ndarray] | None:
        c = np.concatenate([LOWER[codes], np.full(3, 32, np.uint16)])
        kind = KIND[c]
        start = kind != BLANK
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        # 's 't 'm 'd 're 've 'll are tokens, where a run of symbols is one apostrophe before a letter.
        ap = np.flatnonzero((c[:-3] == 39) & start[:-3] & (kind[1:-2] == LETTER))
        one = np.isin(c[ap + 1], [115, 116, 109, 100])
        two = np.isin(c[ap + 1].astype(np.int32) * 65536 + c[ap + 2], [114 * 65536 + 101, 118 * 65536 + 101, 108 * 65536 + 108])
        start[ap[one | two] + 1] = False
        for after in (ap[one] + 2, ap[two] + 3):
            start[after[kind[after] == LETTER]] = True
        first = np.flatnonzero(start)
        if not len(first):
            return [np.empty(0, np.int32) for _ in range(len(begin) - 1)]
        # Words by hash: sum of letter weights times powers of their places.
        c, kind, start, base = c[first[0]:], kind[first[0]:], start[first[0]:], first[0]
        first = first - base
        length = np.add.reduceat(kind != BLANK, first)
        word = np.cumsum(start, dtype=np.int32) - 1
        place = np.arange(len(c), dtype=np.int32) - first.astype(np.int32)[word]
        powers = np.multiply.accumulate(np.full(int(place.max()) + 1, STEP, np.uint64))
        sums = np.add.reduceat(WEIGHT[c] * powers[place], first)
        found, example, which = np.unique(sums, return_index=True, return_inverse=True)
        same = c[(first[example].astype(np.int32)[which])[word] + place] == c
        if not (same | (kind == BLANK)).all() or (length[example][which] != length).any():
            return None
        at, n = first[example], length[example].astype(np.int64)
        known, row = self.known.find(found, c, at, n)
        new = np.flatnonzero(~known)
        ids = self._unknown(found[new], [c[s:s + k].copy() for s, k in zip(at[new].tolist(), n[new].tolist())])
        count, offset = np.empty(len(found), np.int64), np.empty(len(found), np.int64)
        count[known], offset[known] = self.known.count[row[known]], self.known.id_at[row[known]]
        count[new] = [len(x) for x in ids]
        offset[new] = len(self.known.ids) + np.cumsum(count[new]) - count[new]
        flat = np.concatenate([self.known.ids, np.array([i for x in ids for i in x], np.int32)])
        if len(self.recent) > 30_000:
            self._merge()
        count = count[which]
        tokens = flat[_runs(offset[which], count)]
        ends = np.cumsum(count)
        text_of = np.searchsorted(first + base, begin[1:])  # words before the end of each text
        cuts = np.concatenate([[0], ends])[text_of]
        return np.split(tokens, cuts[:-1])


@lru_cache(maxsize=1)
def shared(path: str) -> WordTokens:
    """One per Python worker and file, so that words met in earlier tasks are known."""
    return WordTokens(path)
