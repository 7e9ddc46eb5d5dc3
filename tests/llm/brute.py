"""Plain one-machine versions of the operators' contracts, and awkward small tables."""
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = "[\x20\x09-\x0D]"
WORD = "[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside: extra columns of these names must not disturb them.
CLASHES = ("fp", "_file", "_row", "digest", "norm", "n", "best", "size", "sid", "piece", "part", "key", "text_key", "places", "score", "tile",
           "block", "cid", "v", "code", "group", "host", "node", "rank", "kept", "component_id", "_h", "_b", "toxic", "bad", "spans", "whole",
           "_metadata", "__lang", "__file", "__row", "__parts", "__taken", "epoch")


def words(text):
    return re.findall(WORD, text or "")


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES if c not in df.columns])


def awkward(spark, clashes=True):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a long text."""
    rng = np.random.default_rng(5)
    vocab = ["the", "House", "über", "naïve", "l'été", "x1", "mañana", "z,", "Q"]
    base = " ".join(rng.choice(vocab, 60))
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n\x0b\f\r ", "en", "a", 7), (4, "one", "en", "b", 3),
            (5, "one", "de", "b", 3), (6, "one ", "de", "b", 4), (7, "one two", "en", None, 7), (None, "one two", "en", "c", 7),
            (None, None, None, None, None), (8, base, "en", "a", len(base)), (9, base + " tail", "en", "a", None), (10, base.replace(" ", "  "), "fr", "c", 1),
            (11, "A " + base + " " + base, "fr", "c", 1), (12, "same row", "es", "d", 8), (12, "same row", "es", "d", 8), (12, "other text", "es", "d", 8),
            (13, " ".join(rng.choice(vocab, 30_000)), "en", "a", 9), (14, "日本 語 \U0001F600 é e\u0301 İ", "en", "é", 1), (15, "word " * 200, "en", "z", 1), (16, "Don't <|endoftext|> x<|startoftext|>", "en", "z", 1)]
    df = spark.createDataFrame(rows, DOCS)
    return with_clashes(df) if clashes else df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def components(nodes, links):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in links:
        up[find(a)] = find(b)
    return {x: find(x) for x in nodes}


def fingerprint(text, k=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    n = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for i in range(64):
            n[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * n[i] > len(shingles))


def exact(rows):
    """[(doc_id, text)] -> Counter of (doc_id, keep_id, group_size, sha)."""
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(SPACE, "", t or "")].append((-len(t or ""), d is None, d or 0, d))
    out = Counter()
    for norm, members in groups.items():
        keep = min(members)[3]
        for m in members:
            out[m[3], keep, len(members), hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


def substring(rows, window=35):
    """[(doc_id, text)] -> Counter of (doc_id, n_words, n_removed, sha)."""
    starts = Counter()
    for _, t in rows:
        w = words(t)
        starts.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = Counter()
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def targets(sizes, weights=(1, 2, 3), cap=3):
    """{source: size} -> {source: target}: share by weight, stop at the cap, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped, target = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(cap * sizes[s] for s in stopped)
        wide = sum(weight[s] for s in order if s not in stopped)
        target = {s: cap * sizes[s] if s in stopped else left * weight[s] / wide for s in order}
        over = {s for s in order if s not in stopped and target[s] > cap * sizes[s]}
        if not over:
            return target
        stopped |= over


def quality(text, limits, line_limit=20):
    """A text's (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, dup_line_chars, characters by length)."""
    text = text or ""
    w = words(text)
    total, covered = sum(map(len, w)), {}
    for n in limits:
        seen = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
        covered[n] = {i + j for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for j in range(n)}
    lines = Counter(x for x in text.split("\n") if words(x))
    line_chars = sum((k - 1) * sum(map(len, words(x))) for x, k in lines.items())
    repeat = len(covered[min(limits)])
    failed = len(w) < 10 or 100 * repeat > 20 * len(w)
    chars = [sum(len(w[i]) for i in covered[n]) for n in limits]
    kept = not failed and 100 * line_chars <= line_limit * total and all(100 * c <= m * total for c, m in zip(chars, limits.values()))
    return (len(w), total, len(re.findall(r"[#*$%&|<>]", text)), sum(k - 1 for k in lines.values()), repeat, failed, kept, line_chars, *chars)


def trie(rows):
    """[(conv_id, turn, role, text)] -> sorted node rows of the rebuilt conversations."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [v[3:] for v in sorted(vs)] for c, vs in turns.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
    members, children, sub, out = defaultdict(list), defaultdict(list), {}, []
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        sub[k] = (sum(sub[x][0] for x in children[k]) or 1,
                  sum(sub[x][1] for x in children[k]) + (len(members[k]) - 1) * (len(k[-1][1]) if k else 0))
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), *sub[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)
