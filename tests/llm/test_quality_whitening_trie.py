"""Quality rules, embedding whitening and the conversation trie against plain versions."""
import numpy as np
import pytest

import brute
from cinerank.llm import queries
from cinerank.llm.prefix_trie import build, prefix_trie
from cinerank.llm.quality_rules import NGRAM_LIMITS, _block, repetition_rules
from cinerank.llm.whitening import one_sided_jacobi, pivoted_cholesky, whiten

SF01 = "/root/testdata/sf0.01"
TURNS = "conv_id long, turn long, role string, text string"
VECTORS = "vec_id long, embedding array<float>, label int"


# ---- quality rules

def test_quality_rules_match_brute_force(spark):
    docs = brute.awkward(spark)
    lines = "a line here\n\n \t\na line here\na line here\nand  another\nand another"
    more = spark.createDataFrame([(20, lines, None, None, 1), (21, " ".join("a b c d e f".split() * 3), "en", "a", 2), (22, "x#*$%&|<> é " * 4, "en", "a", 2)], brute.DOCS)
    docs = docs.unionByName(more, allowMissingColumns=True)
    got = sorted([tuple(r) for r in repetition_rules(docs).collect()], key=str)
    want = sorted([(r["doc_id"], *brute.quality(r["text"], NGRAM_LIMITS)) for r in docs.select("doc_id", "text").collect()], key=str)
    assert got == want


def test_quality_rules_block_borders():
    """Texts measured together, alone and in parts give the same."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "bb", "ccc", "é"], k)).encode() for k in (0, 3, 7, 60, 400)] + [b"x " * 700_000, b"\n\n"]
    lengths = tuple(NGRAM_LIMITS)
    together = np.stack(_block(texts, lengths), 1)
    alone = np.concatenate([np.stack(_block([t], lengths), 1) for t in texts])
    assert (together == alone).all()
    assert together[5][:2].tolist() == [700_000, 700_000] and together[5][5] == 700_000


def test_quality_rules_empty_table(spark):
    assert repetition_rules(brute.empty(spark)).count() == 0


def test_quality_rules_keep_prose(spark):
    """Only what is short or fails the base rule goes from the given documents' prose."""
    rows = queries.op11_quality_rules(spark, SF01).where("not base_failed").collect()
    assert len(rows) > 800 and all(r["kept"] for r in rows)


# ---- whitening

@pytest.mark.parametrize("d,n", [(5, 40), (64, 30), (33, 400)])
def test_factor_and_jacobi(d, n):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(n, d)) * np.logspace(0, -3, d)
    c = x - x.mean(0)
    a = c.T @ c
    factor = pivoted_cholesky(a)
    assert factor.shape[1] == min(d, n - 1) and np.allclose(factor @ factor.T, a, atol=1e-12 * abs(a).max())
    values, vectors = one_sided_jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:len(values)], rtol=1e-9)
    assert abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert abs(a @ vectors - vectors * values).max() < 1e-12 * values[0]


def plain_whitening(vectors, most=32):
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    c = np.array(x, float) - np.array(sums) / n
    values, comps = np.linalg.eigh(c.T @ c / n)
    values, comps = values[::-1][:most], comps[:, ::-1][:, :most]
    return n, deviation, c @ comps / np.sqrt(values), values / (c * c).sum() * n


def test_whitening_matches_numpy(spark):
    from cinerank.llm.common import table
    rows = table(spark, SF01, "embeddings").orderBy("vec_id").collect()
    n, deviation, z, share = plain_whitening([r["embedding"] for r in rows])
    got = queries.op12_embedding_whitening(spark, SF01).orderBy("vec_id", "component").toPandas()
    assert len(got) == n * 32 and (got["n"] == n).all() and got["identity_error"].max() < 1e-9 and got["identity_error"].nunique() == 1
    assert got["deviation"].tolist() == [d for d in deviation for _ in range(32)]
    mine = got["whitened"].to_numpy().reshape(n, 32)
    signs = np.sign((mine * z).sum(0))
    assert abs(mine - z * signs).max() < 1e-8
    assert np.allclose(got["explained"].to_numpy().reshape(n, 32)[0], share, rtol=1e-10)


def test_whitening_awkward_rows(spark):
    rng = np.random.default_rng(2)
    good = [[float(np.float32(v)) for v in x] for x in rng.normal(size=(9, 3)) * [1, 20, 400]]
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [1.0, float("inf"), 2.0], [-float("inf")] * 3, [1.0, 2.0], [3e38, 1.0, 1.0], [None] * 3]
    rows = [(i, v, 0) for i, v in enumerate(good + bad)] + [(0, good[0], None), (None, good[1], 1)]
    df = brute.with_clashes(spark.createDataFrame(rows, VECTORS)).withColumn("component", brute_lit("x")).withColumn("_metadata", brute_lit("x"))
    got = whiten(df).toPandas()
    n, deviation, z, _ = plain_whitening(good + [good[0], good[1]])
    assert n == 11 and len(got) == 33 and set(got["vec_id"].dropna()) == set(range(9)) and got["vec_id"].isna().sum() == 3
    assert sorted(int(d) for d in got["deviation"]) == sorted(d for d in deviation for _ in range(3))
    assert np.allclose(sorted(abs(got["whitened"])), sorted(abs(z).ravel()), atol=1e-9) and got["identity_error"].max() < 1e-10


def brute_lit(value):
    from pyspark.sql import functions as F
    return F.lit(value)


def test_whitening_without_spread(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [(1, None, 0)]):
        out = whiten(spark.createDataFrame(rows, VECTORS))
        assert out.columns == columns and out.count() == 0
    line = whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], 0) for i in range(5)], VECTORS))  # rank 1
    assert line.select("component").distinct().count() == 1 and line.count() == 5


def test_whitening_exact_deviation_beyond_longs(spark):
    rows = [(1, [2.0 ** 40, 0.0], 0), (2, [-2.0 ** 40, 1.0], 0), (3, [5.0, 7.0], 0)]
    got = {r["vec_id"]: int(r["deviation"]) for r in whiten(spark.createDataFrame(rows, VECTORS)).collect()}
    assert got == dict(zip((1, 2, 3), plain_whitening([r[1] for r in rows])[1]))


# ---- conversation trie

def test_double_array_holds_exactly_its_paths():
    rng = np.random.default_rng(7)
    for fan in (2, 5, 400):
        paths = [tuple(rng.integers(0, fan, rng.integers(0, 7))) for _ in range(600)] + [tuple(range(50)), (1,) * 30]
        rows = sorted((d + 1, i, int(t)) for i, p in enumerate(paths) for d, t in enumerate(p))
        depth, path, raw = (np.array(c, np.int64) for c in zip(*rows))
        trie, turn = build(path, depth, raw)
        code = {r: int(t) for r, t in zip(raw, turn)}
        assert len(code) == len(set(code.values())) and all(code[r] == t for r, t in zip(raw, turn))
        prefixes = {p[:d] for p in paths for d in range(len(p) + 1)}
        assert (trie.check >= 0).sum() == len(prefixes) - 1
        states = {(): 0}
        for p in sorted(prefixes, key=len):
            for r, c in code.items():
                to = int(trie.step(np.array([states[p]]), np.array([c]))[0])
                assert (to >= 0) == ((*p, r) in prefixes)
                if to >= 0:
                    states[(*p, r)] = to
        assert len(set(states.values())) == len(prefixes)


def turns_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def nodes_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("rows_per_shard", [100_000, 40, 3])
def test_trie_matches_brute_force(spark, rows_per_shard):
    from cinerank.llm.common import table
    turns = table(spark, SF01, "conversations")
    assert nodes_of(prefix_trie(turns, rows_per_shard)) == brute.trie(turns_of(turns))


@pytest.mark.parametrize("rows_per_shard", [100_000, 5])
def test_trie_awkward_turns(spark, rows_per_shard):
    rows = [(100, None, "user", "null turn first"), (100, 1, None, None), (100, 1, "user", ""), (100, 2, "", ""), (100, 3, "user", "é\U0001F600 " * 50), (101, 1, "user", "x"),
            (101, 1, "user", "x"), (None, 1, "user", "nobody's"), (-7, 0, "user", "a"), (-107, 5, "user", "a"), (-100, 5, "user", "a"), (0, 1, "user", "zero"),
            (2 ** 62, 1, "user", "far"), (205, 3, "assistant", "x" * 100_000), (206, 1, "user", "b"), (207, 1, "user", "b"), (207, 2, "user", "c")]
    rows += [(300 + i, t, "user", f"deep {t}") for i in range(12) for t in range(1, 3 + i)]
    df = brute.with_clashes(spark.createDataFrame(rows, TURNS))
    for name in ("key", "depth", "hot", "_base", "_metadata", "shard", "path"):
        df = df.withColumn(name, brute_lit("clash"))
    assert nodes_of(prefix_trie(df, rows_per_shard)) == brute.trie(rows)


def test_trie_hot_groups(spark):
    """A third of the conversations are equal, a third share their first turns, and shards hold 30 turns."""
    rows = [(7 + 100 * i, t, "user", f"same {t}") for i in range(120) for t in range(9)]
    rows += [(100_007 + 100 * i, t, "user", f"start {t}" if t < 6 else f"own {i} {t}") for i in range(120) for t in range(6 + i % 4)]
    rows += [(900_000 + i, t, "user", f"other {i % 50} {t}") for i in range(120) for t in range(3)]
    df = spark.createDataFrame(rows, TURNS)
    got = nodes_of(prefix_trie(df, 30))
    assert got == brute.trie(rows) and got == nodes_of(prefix_trie(df))


def test_trie_empty_table(spark):
    assert prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).count() == 0
