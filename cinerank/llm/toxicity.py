"""Toxicity by weak supervision.

1. Voters. Each votes toxic on a document or abstains: built-in lexicon words and patterns, and
   words and word beginnings (4 to 6 letters) found in the labelled training rows. A found one counts
   the families of documents that have it (near copies share a family, so ten copies of a text are
   one witness), and must be toxic in over half of them by its lower confidence bound.
2. Label model. A generative model of the votes given the hidden class: a firing rate per voter and class
   (its accuracy), and correlations as a tree of dependencies between voters (the spanning tree of largest mutual
   information given the class). Expectation-maximisation over training rows with and without labels; a
   known label counts as a further, nearly certain vote. It gives a posterior label to every row.
3. Classifier. Logistic regression on the presence of the found words and beginnings and of the voters,
   trained on the posterior labels. It scores whole texts; labels, language, source and id never enter.

Counting covers all labelled training rows: rows go to the partition of their family, where each feature is counted once a family, so that
counts and not (feature, family) pairs are shuffled. Families with more rows than a partition holds on average are counted by pairs. The model keeps
the ``most_features`` found features of highest bound (50,000), of which the best ``voters`` (128) vote. The label model and the classifier are fitted on at most
``fit_rows`` distinct training texts, weighted by their copies: whole hash ranges of the labelled and of the unlabelled ones
(a documented bound: their features, not their texts, reach the driver).
Everything is scored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .word_hashes import run_hashes, word_hashes

#: Common insults, as whole words: a starting lexicon, one voter each.
LEXICON = ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "trash", "scum", "clown", "clowns", "pathetic", "worthless",
           "disgusting", "imbecile", "jerk", "bastard", "vermin", "dumpf", "idioten", "dummkopf", "abschaum", "arschloch", "widerlich", "erbärmlich",
           "imbécile", "crétin", "connard", "salaud", "ordure", "minable", "imbécil", "estúpido", "basura", "escoria", "asqueroso", "patético")
#: Phrases over lower-cased text, one voter each.
PATTERNS = (r"\byou(?:'re| are) (?:an? |so |such an? )?(?:fool|idiot|moron|joke|failure|disgrace)\b", r"\bshut up\b", r"\bgo to hell\b",
            r"\bi hate you\b", r"\bhalt die klappe\b", r"\bferme ta gueule\b", r"\bcállate\b", r"\bhijo de puta\b", r"\bkill yourself\b")
#: For each pattern, texts of which a match holds one: looked for first, as that is much cheaper.
HINTS = (("you're ", "you are "), ("shut up",), ("go to hell",), ("i hate you",), ("halt die klappe",), ("ferme ta gueule",), ("cállate",), ("hijo de puta",),
         ("kill yourself",))
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)
#: Slots of the bitmap that tells which features are worth counting among clean rows.
MARKS = 1 << 24


def token_features(token: str) -> list[str]:
    """Words of a lower-cased token and their beginnings (marked by a trailing *)."""
    out = []
    for word in (token,) if token.isalpha() else WORD.findall(token):
        out.append(word)
        out += [word[:n] + "*" for n in STEMS if len(word) > n]
    return out


class Features(dict):
    """Token -> its features that ``wanted`` maps to something other than None, as tuples; remembered for the latest tokens."""

    def __init__(self, wanted=lambda feature: feature, most: int = 300_000):
        super().__init__()
        self.wanted, self.most = wanted, most

    def __missing__(self, token: str) -> tuple:
        if len(self) >= self.most:
            self.clear()
        found = [self.wanted(f) for f in token_features(token)]
        self[token] = out = tuple(f for f in found if f is not None)
        return out

    def of(self, text: str | None) -> set:
        out = set()
        for token in set((text or "").lower().split()):
            out.update(self[token])
        return out


def family(text: str | None, run: int = 5) -> int:
    """Near copies mostly share it: the smallest hash of five consecutive words."""
    words = word_hashes((text or "").lower().encode("utf-8", "replace"))[0]
    h = run_hashes(words, min(run, max(1, len(words))))
    return int(h.min().view(np.int64)) if len(h) else 0


class Matcher:
    """Which of the model's features (words, beginnings, patterns; numbered) a text has."""

    def __init__(self, at: dict[str, int]):
        self.words = {f: i for f, i in at.items() if not f.endswith("*")}
        self.stems = {f[:-1]: i for f, i in at.items() if f.endswith("*")}
        self.heads = {f[:STEMS[0]] for f in self.stems}
        self.patterns = [(hints, re.compile(p), at[p]) for p, hints in zip(PATTERNS, HINTS) if p in at]

    def of(self, text: str | None) -> set[int]:
        if not text:
            return set()
        lower = text.lower()
        words = set()
        for token in set(lower.split()):
            if token.isalpha():
                words.add(token)
            else:
                words.update(WORD.findall(token))
        out = {self.words[w] for w in words & self.words.keys()}
        for w in words:
            if w[:STEMS[0]] in self.heads:
                out.update(self.stems[w[:n]] for n in STEMS if len(w) > n and w[:n] in self.stems)
        for hints, pattern, i in self.patterns:
            if any(x in lower for x in hints) and pattern.search(lower):
                out.add(i)
        return out


def marked(marks: bytes):
    """The feature if its crc32 is marked in a bitmap, else None."""
    def wanted(feature: str) -> str | None:
        slot = zlib.crc32(feature.encode("utf-8", "replace")) % MARKS
        return feature if marks[slot >> 3] >> (slot & 7) & 1 else None
    return wanted


def marks_of(features: DataFrame) -> bytes:
    """A bitmap with the slot of each row's feature set (at most MARKS / 64 numbers reach the driver)."""
    slot = F.crc32(F.col("feature").cast("binary")) % MARKS
    words = features.select(slot.alias("slot")).groupBy(F.expr("slot div 64").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits"))
    out = np.zeros(MARKS // 64, "<i8")
    for r in words.collect():
        out[r["at"]] = r["bits"]
    return out.tobytes()


def with_families(labelled: DataFrame) -> DataFrame:
    """(text, toxic, family), written."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(family=[family(t) for t in batch["text"]])
    rows = labelled.select("text", F.col("toxic").cast("int").alias("toxic"))
    return written(rows.mapInPandas(run, "text string, toxic int, family long"), "toxicity-labelled")


def found_features(labelled: DataFrame, z: float = 3.0) -> DataFrame:
    """(feature, toxic, clean, bound): in how many families of toxic and clean documents each feature occurs and the lower
    bound of the toxic share, for all features where that is over one half. ``labelled`` has text and toxic (0/1); all
    its rows are counted. The clean side is counted for what enough toxic families have: a bitmap leaves out most other
    features early, the join leaves out the rest."""
    least = int(np.floor(z * z)) + 1  # with fewer witnesses no bound reaches one half

    def features(marks: bytes | None) -> Features:
        return Features() if marks is None else Features(marked(marks))

    def pairs(marks: bytes | None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = features(marks)
            for batch in batches:
                for i in range(0, len(batch), 256):
                    names, kin = [], []
                    for text, fam in zip(batch["text"].iloc[i:i + 256], batch["family"].iloc[i:i + 256]):
                        has = known.of(text)
                        names += has
                        kin += [fam] * len(has)
                    yield pd.DataFrame({"feature": pd.Series(names, dtype=object), "family": np.array(kin, np.int64)})
        return run

    def tallied(marks: bytes | None):
        """Rows in the order of family -> (feature, families) of this task."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known, seen, at, has = features(marks), Counter(), None, set()

            def made() -> pd.DataFrame:
                out = pd.DataFrame({"feature": pd.Series(list(seen), dtype=object), "n": np.fromiter(seen.values(), np.int64, len(seen))})
                seen.clear()
                return out
            for batch in batches:
                for text, fam in zip(batch["text"], batch["family"]):
                    if fam != at:
                        seen.update(has)
                        at, has = fam, set()
                    has |= known.of(text)
                if len(seen) > 500_000:
                    yield made()
            seen.update(has)
            yield made()
        return run

    labelled = labelled if "family" in labelled.columns else with_families(labelled)
    partitions = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = labelled.groupBy("family").agg(F.count("*").alias("_n"))
    limit = max(1000, labelled.count() // partitions)
    # Fewer than partitions of them: each has more than the average partition's rows.
    hot = written(sizes.where(F.col("_n") > limit).select("family"), "toxicity-hot")

    def counted(rows: DataFrame, marks: bytes | None, name: str) -> DataFrame:
        rows = rows.select("text", "family")
        calm = rows.join(F.broadcast(hot), "family", "left_anti").repartition("family").sortWithinPartitions("family")
        calm = calm.select("text", "family").mapInPandas(tallied(marks), "feature string, n long")
        large = rows.join(F.broadcast(hot), "family", "left_semi").select("text", "family").mapInPandas(pairs(marks), "feature string, family long")
        large = large.distinct().select("feature", F.lit(1).cast("long").alias("n"))
        return calm.unionByName(large).groupBy("feature").agg(F.sum("n").alias(name))

    toxic = written(counted(labelled.where("toxic = 1"), None, "toxic").where(F.col("toxic") >= least), "toxicity-features")
    clean = counted(labelled.where("toxic = 0"), marks_of(toxic), "clean")
    counts = toxic.join(clean, "feature", "left").fillna(0, ["clean"])
    return counts.withColumn("bound", lower_bound(F.col("toxic"), F.col("toxic") + F.col("clean"), z)).where("bound > 0.5")


def lower_bound(k: Column, n: Column, z: float) -> Column:
    """Wilson's lower confidence bound of k / n."""
    p = k / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


@dataclass
class LabelModel:
    """Class prior, tree of voters, and P(vote | class, parent's vote) as rate[class, parent's vote, voter]."""
    prior: float
    parent: np.ndarray
    rate: np.ndarray

    def posterior(self, votes: np.ndarray, gold: np.ndarray, trust: float = 0.99) -> np.ndarray:
        """P(toxic | votes, known label); gold is 1, 0 or -1 for unknown."""
        above = np.where(self.parent >= 0, votes[:, self.parent], 0)
        out = []
        for y, prior in ((0, 1 - self.prior), (1, self.prior)):
            p = self.rate[y, above, np.arange(votes.shape[1])]
            score = np.log(prior) + np.where(votes == 1, np.log(p), 0.0).sum(axis=1)  # an abstention says nothing
            out.append(score + np.where(gold >= 0, np.log(np.where(gold == y, trust, 1 - trust)), 0.0))
        return 1 / (1 + np.exp(np.clip(out[0] - out[1], -50, 50)))


def fit_label_model(votes: np.ndarray, gold: np.ndarray, weight: np.ndarray, rounds: int = 15, smooth: float = 0.5) -> LabelModel:
    """Expectation-maximisation; starts from the labels where known, else from whether anything fired (last column: nothing did)."""
    n, k = votes.shape
    known = gold >= 0
    share = float((gold[known] * weight[known]).sum() + 1) / float(weight[known].sum() + 10)
    q = np.where(known, gold * 0.98 + 0.01, np.where(votes[:, -1] == 0, 0.8, share * 0.2))
    parent = np.full(k, -1)
    v = votes.astype(np.float64)
    for turn in range(rounds):
        w = np.stack([(1 - q) * weight, q * weight])
        both = np.stack([(v * w[y][:, None]).T @ v for y in (0, 1)])  # weighted pairs of votes
        ones, total = np.stack([v.T @ w[y] for y in (0, 1)]), w.sum(axis=1)
        if turn == 2 and k > 1:
            parent = _tree(both, ones, total, smooth)
        rate = np.empty((2, 2, k))
        has = np.maximum(parent, 0)
        for y in (0, 1):
            alone = (ones[y] + smooth * (0.1 if y == 0 else 1)) / (total[y] + 2 * smooth)
            with_parent = both[y][has, np.arange(k)]
            on = (with_parent + 4 * alone * smooth) / (ones[y][has] + 4 * smooth)
            off = (ones[y] - with_parent + 4 * alone * smooth) / (total[y] - ones[y][has] + 4 * smooth)
            rate[y, 0], rate[y, 1] = np.where(parent >= 0, off, alone), np.where(parent >= 0, on, alone)
        model = LabelModel(float(np.clip((total[1] + 1) / (total.sum() + 10), 1e-4, 0.9)), parent, np.clip(rate, 1e-6, 1 - 1e-6))
        q = model.posterior(votes, gold)
    return model


def _tree(both: np.ndarray, ones: np.ndarray, total: np.ndarray, smooth: float) -> np.ndarray:
    """Parents in the spanning tree of largest mutual information given the class (root: -1); weak links are left out."""
    k, info, everything = len(both[0]), 0.0, total.sum()
    for y in (0, 1):
        t = total[y] + smooth
        p11 = (both[y] + smooth * 0.01) / t
        a, b = np.broadcast_arrays(((ones[y] + smooth * 0.01) / t)[:, None], ((ones[y] + smooth * 0.01) / t)[None, :])
        for p, e in ((p11, a * b), (a - p11, a * (1 - b)), (b - p11, (1 - a) * b), (1 - a - b + p11, (1 - a) * (1 - b))):
            p, e = np.maximum(p, 1e-12), np.maximum(e, 1e-12)
            info = info + total[y] / everything * p * np.log(p / e)
    parent, best, near = np.full(k, -1), info[0].copy(), np.zeros(k, int)
    inside = np.zeros(k, bool)
    inside[0] = True
    for _ in range(k - 1):  # Prim
        i = int(np.argmax(np.where(inside, -np.inf, best)))
        parent[i] = near[i] if best[i] > 1e-6 else -1
        inside[i] = True
        closer = info[i] > best
        best, near = np.where(closer, info[i], best), np.where(closer, i, near)
    return parent


def fit_classifier(rows: np.ndarray, cols: np.ndarray, n: int, start: np.ndarray, q: np.ndarray, weight: np.ndarray,
                   rounds: int = 1500, rate: float = 0.1, l2: float = 0.002) -> np.ndarray:
    """Logistic regression on 0/1 features (row, column pairs), soft labels q; weights, held towards ``start``,
    and, last, the bias. Adam."""
    width = len(start)
    w, m, s = np.append(start, 0.0), np.zeros(width + 1), np.zeros(width + 1)
    share = np.clip((q * weight).sum() / max(weight.sum(), 1e-9), 1e-4, 0.5)
    w[-1] = np.log(share / (1 - share))
    for t in range(1, rounds + 1):
        z = np.bincount(rows, weights=w[cols], minlength=n) + w[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - q) * weight
        grad = np.append(np.bincount(cols, weights=g[rows], minlength=width) + l2 * (w[:-1] - start), g.sum())
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad * grad
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
    return w


@dataclass
class ToxicityModel:
    """Features (words, beginnings, patterns) with weights and a bias; ``voters`` name the label model's columns."""
    names: list[str]
    weights: np.ndarray
    voters: list[str]
    label_model: LabelModel | None

    def score(self, text: Column) -> Column:
        """Probability of toxic, 0 to 1; a text without any feature (null, empty) has the bias's."""
        names, weights = {f: i for i, f in enumerate(self.names)}, self.weights

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known = Matcher(names)
            for texts in batches:
                z = np.array([weights[-1] + sum(weights[at] for at in sorted(known.of(t))) for t in texts], float)
                yield pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))))
        return run(text)


def hash_of(text: Column) -> Column:
    """The hash by which the fitting sample is drawn: 0 to 2^60 - 1."""
    return F.shiftrightunsigned(F.xxhash64(text, F.lit(7)), 4)


def sample_cuts(train: DataFrame, most: int) -> tuple[int, int]:
    """Hashes below which labelled and unlabelled rows are in the fitting sample, at most ``most`` (text, label) of them
    together, copies counted once. Either kind may take half of that, and what the other leaves. Whole hash ranges (of 4,096) are taken;
    where not even the first fits, it is cut into as many again."""
    return cuts_of(train.select(hash_of(F.col("text")).alias("h"), "toxic"), most)


def cuts_of(hashes: DataFrame, most: int) -> tuple[int, int]:
    """``sample_cuts`` from (h, toxic) of the rows."""
    once = written(hashes.select("h", "toxic", F.col("toxic").isNotNull().alias("known")).distinct().select("h", "known"), "toxicity-hashes")
    sizes = {r["known"]: r["count"] for r in once.groupBy("known").count().collect()}

    def cut(kind: bool, bound: int) -> int:
        low, size = 0, 0
        for shift in (48, 36, 24, 12, 0):
            at = F.shiftright(F.col("h") - low, shift)
            for r in sorted(once.where((F.col("known") == kind) & (at >= 0) & (at < 4096)).groupBy(at.alias("r")).count().collect()):
                if size + r["count"] > bound:
                    break
                size += r["count"]
            else:
                return 1 << 60
            low += r["r"] << shift
            if size:
                break
        return low

    of, half = [sizes.get(kind, 0) for kind in (True, False)], most // 2
    return cut(True, max(half, most - of[1])), cut(False, max(half, most - of[0]))


def fit(labelled: DataFrame, unlabelled: DataFrame, hashes: DataFrame, z: float = 3.0, voters: int = 128, fit_rows: int = 100_000,
        most_features: int = 50_000) -> ToxicityModel:
    """From ``labelled`` (text, toxic 0/1) and ``unlabelled`` (text) rows; ``hashes`` (h) are the ``hash_of`` the unlabelled ones. Every feature
    is counted; the model holds the ``most_features`` that pass with the highest bound."""
    labelled = with_families(labelled)
    counts = found_features(labelled, z)
    best = counts.orderBy(F.desc("bound"), F.desc("toxic"), "feature").limit(most_features).select("feature").collect()
    found = [r["feature"] for r in best]
    names = [*LEXICON, *PATTERNS, *[f for f in found if f not in LEXICON]]
    at = {f: i for i, f in enumerate(names)}

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Matcher(at)
        for batch in batches:
            has = [sorted(known.of(t)) for t in batch["text"]]
            yield pd.DataFrame({"has": has, "toxic": batch["toxic"].astype("Int32")})

    nothing, h = F.lit(None).cast("int").alias("toxic"), hash_of(F.col("text"))
    below, below_unlabelled = cuts_of(labelled.select(h.alias("h"), "toxic").unionByName(hashes.select("h", nothing)), fit_rows)
    sample = labelled.where(h < below).select("text", "toxic").unionByName(unlabelled.where(h < below_unlabelled).select("text", nothing))
    rows = sample.mapInPandas(present, "has array<int>, toxic int")
    rows = rows.groupBy("has", "toxic").agg(F.count("*").alias("w")).orderBy("has", "toxic").collect()
    start = np.where(np.arange(len(names)) < len(LEXICON) + len(PATTERNS), 4.0, 0.0)  # what built-in voters weigh before any evidence
    if not rows:
        return ToxicityModel(names, np.append(start, -2.0), [], None)
    r = np.repeat(np.arange(len(rows)), [len(x["has"]) for x in rows])
    c = np.array([i for x in rows for i in x["has"]], np.int64)
    gold, weight = np.array([-1 if x["toxic"] is None else x["toxic"] for x in rows]), np.array([x["w"] for x in rows], float)
    # Voters: the lexicon, the patterns and the best found features.
    width = min(len(names), len(LEXICON) + len(PATTERNS) + voters)
    votes = np.zeros((len(rows), width + 1), np.int8)
    votes[r[c < width], c[c < width]] = 1
    votes[:, width] = ~votes.any(axis=1)  # one more voter speaks where all others abstain
    label_model = fit_label_model(votes, gold, weight)
    q = label_model.posterior(votes, gold)
    return ToxicityModel(names, fit_classifier(r, c, len(rows), start, q, weight), [*names[:width], "(silence)"], label_model)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels may not be learned from: crc32 of the id as text leaves 1 modulo 3. A null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document: (id_col, held_out, score, predicted).

    ``labels`` has (id_col, toxic 0/1); rows held out, null ids and null labels aren't learned from, several labels of
    an id count as toxic if one is. Null texts count as empty. Repeated rows come back as often as they came. Other
    columns are ignored; an empty table gives an empty result, and without any label the lexicon and patterns decide.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    train = docs.where(~held_out(F.col(id_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = known.hint("merge")  # never a broadcast: labels grow with the documents
    labelled = train.join(known, "doc_id").select("text", "toxic")
    # Of unlabelled rows only hashes go through the join, and the texts of the few that are sampled.
    hashes = train.select("doc_id", hash_of(F.col("text")).alias("h")).join(known, "doc_id", "left_anti").select("h")
    model = fit(labelled, train.join(known, "doc_id", "left_anti").select("text"), hashes, **how)
    score = model.score(F.col(text_col))
    return docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
