"""Embedding near-duplicates by iterative quantisation and multi-index tables.

Unit vectors are centred by the mean of their label, projected on the principal directions of what is left
and turned by a rotation that is learned (iterative quantisation), so that the signs form balanced binary codes of up to 64
bits; further rotations append further bits. The codes are cut into substrings, each the key of one table: two vectors of a label
are candidates when they agree in a substring, and are reranked by the cosine of the original vectors in double precision.

How wide a substring may be, and how many tables it takes, depends on the data and on the label's size. On a sample it is
estimated, for each width, how many tables let RECALL of the pairs at the threshold meet and which share of other pairs
meets too. A label gets the width whose comparisons and copies cost least: wider substrings for larger labels, so that
buckets stay small, and one table with an empty key (all pairs) where that is the cheapest, as in small labels.

Equal vectors of a label are one class with a count. A bucket of more than ``block`` classes is
split: each block is a work item, past which the classes of earlier blocks stream. A
pair met in several tables counts in the first of them only, which each item can tell from
the two codes. Items give numbers of links and stars, never pairs.

Learning takes a bounded sample (at most ``fit_numbers`` numbers: rows times dimensions, in the order of the vectors' hashes);
every vector is indexed. Means are sums of whole numbers, so neither depends on the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import components, forest, written

BITS = 64
#: Share of pairs at the threshold that must meet by estimate; widths of substrings to choose from, and the most rotations.
RECALL, WIDTHS, ROTATIONS = 0.95, range(4, 31, 2), 8
#: Means are added up in units of 2^-30.
UNIT = float(1 << 30)


def learn_rotation(centred: np.ndarray, rounds: int = 50, seed: int = 42) -> np.ndarray:
    """A projection to at most 64 numbers whose signs are the code, from centred rows."""
    values, directions = np.linalg.eigh(centred.T @ centred / max(1, len(centred)))
    directions = directions[:, np.argsort(-values, kind="stable")[:BITS]]
    v = centred @ directions
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):  # codes for the rotation, then the best rotation for the codes
        signs = np.where(v @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(v.T @ signs)
        rotation = left @ right
    return directions @ rotation


def _matrix(vectors, dim: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        if v is not None:
            out[i, :len(v)] = v
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def signs(centred: np.ndarray, projections: list[np.ndarray]) -> np.ndarray:
    """Code bits, a row per centred vector."""
    return np.concatenate([centred @ p >= 0 for p in projections], axis=1)


def substrings(bits: np.ndarray, width: int, tables: int) -> np.ndarray:
    """The first ``tables`` substrings of ``width`` bits as numbers, a row per vector; width 0: one key that all share."""
    if not width:
        return np.zeros((len(bits), 1), np.uint32)
    return bits[:, :width * tables].reshape(len(bits), tables, width) @ (1 << np.arange(width)).astype(np.uint32)


def pairs_at(x: np.ndarray, centred: np.ndarray, threshold: float, n: int = 4096, seed: int = 43) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` (their numbers), and each turned until its cosine with itself is ``threshold``, in a direction in which vectors of
    one label differ: where another row lies from its label's mean."""
    i, j = np.random.default_rng(seed).integers(len(x), size=(2, n))
    aside = centred[j] - (x[i] * centred[j]).sum(axis=1, keepdims=True) * x[i]
    size = np.linalg.norm(aside, axis=1, keepdims=True)
    some = size[:, 0] > 1e-6
    i, aside = i[some], aside[some] / size[some]
    return i, threshold * x[i] + np.sqrt(max(0.0, 1 - threshold * threshold)) * aside


@dataclass
class Tables:
    """The learned projections and, for labels of up to 2^tier classes, (width, number of tables)."""
    projections: list[np.ndarray]
    plans: dict[int, tuple[int, int]]


def _choices(near: np.ndarray, other: np.ndarray) -> list[tuple[int, int, float]]:
    """(width, tables, share of pairs compared) for the widths that reach RECALL, from which bits differ in pairs at the threshold
    and in any pairs; width 0 compares each pair once."""
    out = [(0, 1, 1.0)]
    for width in WIDTHS:
        most = near.shape[1] // width
        if not most:
            break
        apart, differ = (d[:, :most * width].reshape(len(d), most, width).any(axis=2) for d in (near, other))
        enough = np.flatnonzero(np.logical_and.accumulate(apart, axis=1).mean(axis=0) <= 1 - RECALL)
        if len(enough):
            tables = int(enough[0]) + 1
            out.append((width, tables, tables * max(2.0 ** -width, 1 - differ[:, :tables].mean())))
    return out


def learn_tables(x: np.ndarray, means: np.ndarray, threshold: float, tiers: list[int], row_cost: float) -> Tables:
    """Projections and a plan for each tier, from unit vectors and their labels' means. Rotations are added as long as they
    make the plan of the largest labels cheaper."""
    centred = x - means
    i, turned = pairs_at(x, centred, threshold)
    if not len(i):  # no label with two vectors in the sample
        return Tables([], {t: (0, 1) for t in tiers})
    left, right = centred[i], turned - means[i]
    a, b = np.random.default_rng(44).integers(len(x), size=(2, 100_000))
    a, b = a[a != b], b[a != b]
    cost = lambda n, c: n * n / 2 * c[2] + row_cost * n * c[1]
    projections, near, other = [], np.zeros((len(left), 0), bool), np.zeros((len(a), 0), bool)
    best, wanted = [(0, 1, 1.0)], 1
    while wanted <= ROTATIONS:
        while len(projections) < wanted:
            p = learn_rotation(centred) if not projections else learn_rotation(centred[:20_000], rounds=20, seed=42 + len(projections))
            bits = signs(centred, [p])
            near = np.concatenate([near, signs(left, [p]) != signs(right, [p])], axis=1)
            other = np.concatenate([other, bits[a] != bits[b]], axis=1)
            projections.append(p)
        found, n = _choices(near, other), 2.0 ** max(tiers)
        better = min(cost(n, c) for c in found) < 0.95 * min(cost(n, c) for c in best)
        best = found if better else best
        if not better and len(best) > 1:
            break
        wanted *= 2
    plans = {t: min(best, key=lambda c: cost(2.0 ** t, c))[:2] for t in tiers}
    bits = max(w * t for w, t in plans.values())
    return Tables([p for k, p in enumerate(projections) if sum(q.shape[1] for q in projections[:k]) < bits], plans)


def label_means(classes: DataFrame, dim: int) -> DataFrame:
    """(group, mean): means of the unit vectors of each label, tasks' sums added up as whole numbers."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.rint(_unit(_matrix(batch["v"].tolist(), dim)) * UNIT).astype(np.int64)
            group, at, n = np.unique(batch["group"].to_numpy(), return_inverse=True, return_counts=True)
            if len(group):
                s = np.add.reduceat(x[np.argsort(at, kind="stable")], np.cumsum(n) - n, axis=0)
                yield pd.DataFrame({"group": group, "n": n.astype(np.int64), "s": list(s)})

    sums = classes.select("group", "v").mapInPandas(partial, "group long, n long, s array<long>")
    sums = sums.select("group", "n", F.posexplode("s").alias("at", "x")).groupBy("group", "at").agg(
        (F.sum("x").cast("double") / UNIT / F.sum("n")).alias("x"))
    return sums.groupBy("group").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda e: e["x"]).alias("mean"))


def _rows(vectors: list[bytes], dim: int, kind: str) -> np.ndarray:
    """Vectors from their bytes, as doubles."""
    return _matrix([np.frombuffer(v, kind) for v in vectors], dim)


def _links(items: Iterator[pd.DataFrame], threshold: float, dim: int, kind: str) -> Iterator[pd.DataFrame]:
    """Rows sorted by (place, key, item, visiting): (a, b, n): class a has n links more, or a star a-b (n = 0)."""
    key, own = None, None
    for batch in items:
        x, n = _rows(batch["v"].tolist(), dim, kind), batch["n"].to_numpy()
        size, cid = np.linalg.norm(x, axis=1), batch["cid"].to_numpy()
        code = batch["code"].to_numpy()
        place, visiting = batch["place"].to_numpy(), batch["visiting"].to_numpy()
        same = [batch[c].to_numpy() for c in ("group", "place", "key", "item", "visiting")]
        cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in same])) + 1
        gained, a, b = {}, [], []

        def compare(left, right, inside: bool, bucket: int) -> None:
            xl, sl, cl, kl, nl = left
            for i in range(0, len(right[0]), 1024):
                xr, sr, cr, kr, nr = (c[i:i + 1024] for c in right)
                r, l = np.nonzero(xr @ xl.T >= threshold * sr[:, None] * sl[None, :])
                keep = (l < r + i) if inside else np.ones(len(r), bool)
                r, l = r[keep], l[keep]
                for earlier in range(bucket):  # a pair counts in the first table where its substrings agree
                    keep = cr[r, earlier] != cl[l, earlier]
                    r, l = r[keep], l[keep]
                if len(r):
                    for k, w in ((kr[r], nl[l]), (kl[l], nr[r])):
                        u, at = np.unique(k, return_inverse=True)
                        for c, s in zip(u.tolist(), np.bincount(at, weights=w).tolist()):
                            gained[c] = gained.get(c, 0) + int(s)
                    u, v = forest(kr[r], kl[l])
                    a.append(u), b.append(v)

        fresh = np.zeros(len(cid) + 1, bool)  # where an item begins
        fresh[1:-1] = np.logical_or.reduce([c[1:] != c[:-1] for c in same[:-1]])
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(cid)]):
            if i == j or j == i + 1 and fresh[i] and fresh[j]:  # nothing, or alone in its bucket
                continue
            decoded = np.frombuffer(b"".join(code[i:j]), np.uint32).reshape(j - i, -1)
            part = (x[i:j], size[i:j], decoded, cid[i:j], n[i:j])
            now = tuple(c[i] for c in same[:-1])
            if key != now:
                key, own = now, None
            if own is not None:
                compare(own, part, False, int(place[i]))
            if not visiting[i]:
                compare(part, part, True, int(place[i]))
                own = part if own is None else tuple(np.concatenate(c) for c in zip(own, part))
        if gained:
            u, v = forest(np.concatenate(a), np.concatenate(b))
            yield pd.DataFrame({"a": np.concatenate([np.array(list(gained), np.int64), u]),
                                "b": np.concatenate([np.zeros(len(gained), np.int64), v]),
                                "n": np.concatenate([np.array(list(gained.values()), np.int64), np.zeros(len(u), np.int64)])})


def _index(classes: DataFrame, dim: int, n: int, threshold: float, fit_numbers: int, row_cost: float) -> tuple[DataFrame, Tables]:
    """The classes with their label's mean and tier, and the tables learned from a sample of them."""
    sizes = classes.groupBy("group").agg(F.ceil(F.log2(F.count("*"))).cast("int").alias("tier"))
    sizes = written(sizes, "embedding-labels")
    tiers = sorted(r["tier"] for r in sizes.select("tier").distinct().collect())
    # Labels in which one table with all pairs is cheaper than two tables need no mean.
    large = sizes.where(F.pow(F.lit(2.0), F.col("tier")) > 2 * row_cost)
    means = written(label_means(classes.join(large, "group", "left_semi"), dim), "embedding-means")
    classes = classes.join(sizes.join(means, "group", "left"), "group")
    fit, wide = max(1, fit_numbers // dim), 1 << 40
    order = F.pmod(F.xxhash64("k2", "k1"), F.lit(wide))
    sample = classes.where(F.col("mean").isNotNull()).where(order < min(wide, int(wide * 2 * (fit + 100) / n) + 1))
    sample = sample.orderBy(order, "k1", "k2").select("v", "mean").limit(fit).toArrow()
    if not sample.num_rows:
        return classes, Tables([], {t: (0, 1) for t in tiers})
    x, m = (_matrix(sample[c].to_pandas(), dim) for c in ("v", "mean"))
    return classes, learn_tables(_unit(x), m, threshold, tiers, row_cost)


def _dealt(classes: DataFrame, tables: Tables, dim: int, kind: str) -> DataFrame:
    """A row per class and table: (cid, group, n, v binary, code binary, place, key)."""
    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, tier = _matrix(batch["v"].tolist(), dim), batch["tier"].to_numpy()
            keys = np.empty(len(batch), object)
            for t in np.unique(tier):
                width, of = tables.plans[int(t)]
                at = np.flatnonzero(tier == t)
                bits = np.zeros((len(at), 0), bool)
                if width:
                    bits = signs(_unit(x[at]) - _matrix(batch["mean"].iloc[at].tolist(), dim), tables.projections)
                for i, row in zip(at.tolist(), substrings(bits, width, of).astype(np.uint32)):
                    keys[i] = row
            yield pd.DataFrame({"cid": batch["cid"], "group": batch["group"], "n": batch["n"],
                                "v": [np.asarray(v, kind).tobytes() for v in batch["v"]], "code": [k.tobytes() for k in keys],
                                "keys": [k.astype(np.int32) for k in keys]})

    rows = classes.select("cid", "group", "n", "v", "tier", "mean").mapInPandas(
        coded, "cid long, group long, n long, v binary, code binary, keys array<int>")
    return rows.select("cid", "group", "n", "v", "code", F.posexplode("keys").alias("place", "key"))


def embedding_dedup(vectors: DataFrame, threshold: float = 0.93, block: int = 2048, fit_numbers: int = 2_000_000, row_cost: float = 200.0,
                    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per input row: (id_col, n_links, component_id, kept).

    Vectors are compared when their labels are equal and not null (and they are of equal length); a
    vector that is null, empty, zero or holds a null or non-finite component links with nothing. n_links counts the
    other rows linked directly, component_id is the smallest id reachable (null if all are null), kept means
    that it is the row's own id. Equal rows link with each other. Other columns are ignored; an empty table
    gives an empty result. ``row_cost`` is what a vector's copy in a table costs, in comparisons.
    """
    v = F.col(vector_col).cast("array<double>")
    good = (F.col(label_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(good, F.lit(False)).alias("good"), v.alias("v"),
                          F.xxhash64(label_col, F.size(v)).alias("group"), F.monotonically_increasing_id().alias("rid"))
    same = [F.xxhash64("group", "v").alias("k1"), F.xxhash64("v", F.lit(1), "group").alias("k2")]
    rows = written(rows.select("vec_id", "good", "v", "group", "rid", *same), "embedding-rows")
    classes = rows.where("good").groupBy("k1", "k2").agg(
        F.first("v").alias("v"), F.first("group").alias("group"), F.count("*").alias("n"), F.min("rid").alias("cid"), F.min("vec_id").alias("least"))
    classes = written(classes, "embedding-classes")
    found = classes.agg(F.max(F.size("v")), F.count("*")).first()
    dim = found[0]
    if dim is None:
        return rows.select(F.col("vec_id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    given = vectors.schema[vector_col].dataType
    kind = "float32" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "float64"  # copies hold what was given
    dealt = _dealt(*_index(classes, dim, found[1], threshold, fit_numbers, row_cost), dim, kind)
    # Buckets with more than one block (few): their classes visit the later blocks.
    large = dealt.groupBy("group", "place", "key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).where("blocks > 1")
    dealt = dealt.join(written(large, "embedding-buckets"), ["group", "place", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    items = dealt.withColumn("_own", own).select("*", F.explode(F.sequence("_own", F.col("blocks") - 1)).alias("item"))
    items = items.withColumn("visiting", F.col("item") > F.col("_own")).drop("_own", "blocks")
    items = items.repartition("group", "place", "key", "item").sortWithinPartitions("group", "place", "key", "item", "visiting")
    found = written(items.mapInPandas(lambda it: _links(it, threshold, dim, kind), "a long, b long, n long"), "embedding-links")

    degrees = found.where("n > 0").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("linked"))
    roots = components(found.where("n = 0"), "embedding")
    merged = classes.select("cid", "k1", "k2", "n", "least").join(roots.withColumnRenamed("node", "cid"), "cid", "left").join(degrees, "cid", "left")
    merged = merged.withColumn("root", F.coalesce("root", "cid"))
    joint = merged.groupBy("root").agg(F.min("least").alias("joint"))
    merged = merged.join(joint, "root").select("k1", "k2", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "joint")
    return rows.select("vec_id", "good", "k1", "k2").join(merged.withColumn("good", F.lit(True)), ["k1", "k2", "good"], "left").select(
        F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("good"), F.col("joint")).otherwise(F.col("vec_id")).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.when(F.col("good"), F.col("joint")).otherwise(F.col("vec_id")), F.lit(False)).alias("kept"))
