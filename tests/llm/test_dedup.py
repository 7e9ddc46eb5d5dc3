"""SimHash, exact, embedding and substring dedup against brute force, with awkward tables."""
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from cinerank.llm import common, word_hashes
from cinerank.llm import embedding_dedup as embedding
from cinerank.llm.embedding_dedup import embedding_dedup
from cinerank.llm.exact_dedup import DedupState, exact_dedup, normalised, sha256
from cinerank.llm.simhash_dedup import bit_totals, fingerprint, fingerprint_links, simhash_dedup
from cinerank.llm.substring_dedup import lengths, repeated_spans, substring_dedup
from cinerank.session import scratch_path


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_fingerprints():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    assert bit_totals(h).tolist() == [int(((h >> np.uint64(i)) & np.uint64(1)).sum()) for i in range(64)]
    for text in (None, "", " \t", "One", "one TWO", "a b c", "É é a\x0bb\x1cc d e f g" * 40):
        want = brute.fingerprint(text)
        assert fingerprint(None if text is None else text.encode(), 3) % (1 << 64) == want
        assert fingerprint((text or "").encode(), 3, chunk=4) % (1 << 64) == want


def test_fingerprint_links_meet_every_pair(spark):
    """All pairs within the radius end up connected, with blocks of two fingerprints as with large ones."""
    rng = np.random.default_rng(2)
    fps = set(rng.integers(0, 1 << 63, 150, dtype=np.uint64).tolist())
    for f in list(fps)[:60]:
        for _ in range(3):
            fps.add(f ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    a = np.array(sorted(fps), np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(a[:, None] ^ a[None, :]) <= 2, 1))
    want = brute.components(range(len(a)), near.tolist())
    df = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp long")
    at = {int(x): i for i, x in enumerate(a.view(np.int64))}
    for block in (2, 4096):
        got = brute.components(range(len(a)), [(at[r.a], at[r.b]) for r in fingerprint_links(df, 2, block).collect()])
        assert len(set(got.values())) == len(set(want.values()))
        assert all((got[i] == got[j]) == (want[i] == want[j]) for i, j in near.tolist())


def check_simhash(df):
    rows = rows_of(df)
    fps = [brute.fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    comp = brute.components(range(len(rows)), links)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[comp[i]] = min(least.get(comp[i], d), d)
    want = Counter((d, f"{fps[i]:016x}", least.get(comp[i])) for i, (d, _) in enumerate(rows))
    got = simhash_dedup(df).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert sum(r.kept for r in got) == len(set(comp.values()))


def test_simhash_awkward_and_empty(spark):
    check_simhash(brute.awkward(spark))
    assert simhash_dedup(brute.empty(spark)).collect() == []


def test_components_of_long_chains(spark):
    n = 300
    links = [(i, i + 1) for i in range(n)] + [(1000 + i, 1000) for i in range(1, 400)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(400)}}


def check_exact(df, **how):
    got = exact_dedup(df, **how).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute.exact(rows_of(df))
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_awkward_and_empty(spark):
    check_exact(brute.awkward(spark))
    assert exact_dedup(brute.empty(spark)).collect() == []


def test_exact_full_bytes_decide_when_digests_clash(spark):
    check_exact(brute.awkward(spark, clashes=False), digest=lambda norm: F.substring(sha256(norm), 1, 1))


def test_exact_state_goes_on(spark, tmp_path):
    """Two batches into one state, the second after a restart: judged against all so far."""
    rows = rows_of(brute.awkward(spark, clashes=False))
    paths = []
    for i, part in enumerate((rows[:9], rows[9:])):
        path = str(tmp_path / f"p{i}")
        spark.createDataFrame(part, "doc_id long, text string").write.parquet(path)
        paths.append(path)
    home = scratch_path(spark, "state-test")
    exact_dedup(spark.read.parquet(paths[0]), DedupState(spark, home)).collect()
    state = DedupState(spark, home)
    exact_dedup(spark.read.parquet(paths[1]), state).collect()
    got = {(r.digest, r.best.doc_id, r.n) for r in state.groups().collect()}
    assert got == {(sha, keep, n) for (_, keep, n, sha) in brute.exact(rows)}


@pytest.mark.parametrize("width", [1, 64])
def test_exact_earlier_batches_meet_on_full_bytes(spark, tmp_path, width):
    """Of two batches in one state the second call returns its own rows, and a text that only shares an earlier one's digest is new."""
    rows = rows_of(brute.awkward(spark, clashes=False)) + [(7000 + i, f"only the second batch says {i}") for i in range(40)]
    state, got = DedupState(spark, scratch_path(spark, "state-test")), []
    for i, part in enumerate((rows[:9], rows[9:])):
        path = str(tmp_path / f"p {i}")
        spark.createDataFrame(part, "doc_id long, text string").write.parquet(path)
        got = exact_dedup(spark.read.parquet(path), state, digest=sha256 if width == 64 else lambda norm: F.substring(sha256(norm), 1, 1)).collect()
    groups = {sha: (keep, n) for _, keep, n, sha in brute.exact(rows)}
    want = Counter()
    for (doc_id, _, _, sha), n in brute.exact(rows[9:]).items():
        want[(doc_id, *groups[sha], sha)] += n
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want


def check_substring(df, **how):
    got = Counter(tuple(r) for r in substring_dedup(df, **how).collect())
    assert got == brute.substring(rows_of(df), how.get("window", 35))


def test_substring_awkward_and_empty(spark):
    check_substring(brute.awkward(spark))
    assert substring_dedup(brute.empty(spark)).collect() == []


@pytest.mark.parametrize("window,first", [(2, None), (5, None), (35, None), (5, 1), (35, 5), (35, 9)])
def test_substring_random(spark, window, first):
    """Passages shared by documents, inside one document, and overlapping themselves."""
    rng = np.random.default_rng(window)
    passages = [" ".join(rng.choice(list("abcdefgh"), n)) for n in (34, 35, 36, 80, 200)]
    texts = []
    for i in range(60):
        t = " ".join(rng.choice([f"w{k}" for k in range(4000)], rng.integers(0, 120)))
        for p in rng.choice(passages, rng.integers(0, 3)):
            t += " " + p + " " + f"u{i}"
        texts.append(t)
    texts += ["x " * 34, "y " * 35, "z " * 36, texts[3], texts[3]]
    check_substring(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), window=window, first=first)


def test_substring_levels():
    assert lengths(35, 35) == [18] and lengths(35, 9) == [9, 18] and lengths(35, 5) == [5, 9, 18] and lengths(2, 1) == [1]


@pytest.mark.parametrize("first", [None, 9])
def test_substring_different_texts_with_one_key(spark, monkeypatch, first):
    """Texts that share the first hash are not taken for copies of each other."""
    from cinerank.llm import substring_dedup as module
    from pyspark.sql import functions as F
    monkeypatch.setattr(module, "_text_keys", lambda text: (F.pmod(F.xxhash64(text), F.lit(3)), F.xxhash64(F.lit(1), text)))
    check_substring(brute.awkward(spark), first=first)


def test_substring_ends_where_no_candidate_survives(spark):
    rows = [(i, " ".join(f"w{i} {k}" for k in range(60))) for i in range(5)]
    check_substring(spark.createDataFrame(rows, "doc_id long, text string"), first=9)


def test_parts_cover_windows():
    text = b" ".join(f"w{i}".encode() for i in range(1000))
    whole = word_hashes.word_hashes(text)[0]
    for limit in (50, 300, 5000):
        seen = {}
        for at, part in word_hashes.parts(text, 9, limit):
            h = word_hashes.word_hashes(part)[0]
            assert (h == whole[at:at + len(h)]).all()
            seen.update({at + i: True for i in range(len(h) - 9)})
        assert sorted(seen) == list(range(len(whole) - 9))


def vectors(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return brute.with_clashes(df) if extra else df


def brute_vectors(rows, threshold=0.93):
    x = []
    for _, v, label in rows:
        a = None if v is None or any(c is None for c in v) or not len(v) else np.array(v, np.float32).astype(np.float64)
        x.append(None if a is None or label is None or not np.isfinite(a).all() or not a.any() else a / np.linalg.norm(a))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2]
             and len(x[i]) == len(x[j]) and x[i] @ x[j] >= threshold]
    comp = brute.components(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[comp[i]] = min(least.get(comp[i], r[0]), r[0])
    n = Counter(i for pair in links for i in pair)
    return Counter((r[0], n[i], least.get(comp[i])) for i, r in enumerate(rows)), len(links)


@pytest.mark.parametrize("block", [8, 2048])
def test_embeddings_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for centre in rng.normal(size=(40, 64)):
        for _ in range(int(rng.integers(1, 6))):
            rows.append((k, (centre + 0.1 * rng.normal(size=64)).tolist(), int(k % 3 > 0)))
            k += 1
    rows += [(900 + i, rows[0][1], 0) for i in range(30)]
    rows += [(950, None, 1), (951, [0.0] * 64, 1), (952, [float("nan")] * 64, 1), (953, rows[1][1], None), (954, [1.0, None], 1),
             (955, [float("inf")] + [0.0] * 63, 1), (956, [], 1), (957, rows[2][1][:32], 1), (None, rows[2][1], 1), (958, rows[2][1], 1), (958, rows[2][1], 1)]
    want, _ = brute_vectors(rows)
    got = embedding_dedup(vectors(spark, rows), block=block).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_embedding_recall_near_the_threshold(spark):
    """Pairs barely over the threshold: at least nine tenths of the brute-force links, none beside them."""
    rng = np.random.default_rng(4)
    rows = []
    for i, c in enumerate(rng.normal(size=(400, 64))):
        rows += [(2 * i, c.tolist(), 1), (2 * i + 1, (c + 0.3 * rng.normal(size=64)).tolist(), 1)]
    want, links = brute_vectors(rows)
    got = embedding_dedup(vectors(spark, rows, False)).collect()
    found = sum(r.n_links for r in got) / 2
    assert links > 300 and 0.9 * links <= found <= links
    allowed = {r[0]: r[1] for r in want}
    assert all(r.n_links <= allowed[r.vec_id] for r in got)


@pytest.mark.parametrize("dim, common", [(64, 0.0), (64, 0.5), (64, 0.8), (16, 0.0), (16, 0.6), (6, 0.0)])
def test_embedding_recall_with_a_common_mean_and_few_dimensions(spark, dim, common):
    """Pairs at cosine 0.93 to 0.94 of vectors in which one common direction holds the share ``common`` of the squared norm."""
    rng = np.random.default_rng(10)
    same, rows, wanted = rng.normal(size=dim), [], {}
    same /= np.linalg.norm(same)
    aside = lambda v, *of: np.linalg.qr(np.stack([*of, v]).T)[0][:, -1]
    for i in range(1200):
        own = aside(rng.normal(size=dim), same)
        turn = (rng.uniform(0.93, 0.94) - common) / (1 - common)
        other = turn * own + np.sqrt(1 - turn * turn) * aside(rng.normal(size=dim), same, own)
        rows += [(2 * i + k, (np.sqrt(common) * same + np.sqrt(1 - common) * v).tolist(), i // 8) for k, v in enumerate((own, other))]
    df = vectors(spark, rows, False)
    want, links = brute_vectors(rows)
    got = {r.vec_id: r.n_links for r in embedding_dedup(df).collect()}
    assert links >= 1100 and 0.9 * links <= sum(got.values()) / 2 <= links
    assert all(got[r[0]] <= r[1] for r in want)


@pytest.mark.parametrize("spread", [0.0, 0.5, 2.0])
def test_embedding_index_with_separated_labels(spark, spread):
    """Labels around centres ``spread`` times the vectors' own norm: the index finds nine tenths of the links and compares few pairs."""
    rng = np.random.default_rng(11)
    rows, centres = [], spread * rng.normal(size=(3, 64))
    for i in range(3000):
        v, label = rng.normal(size=64), i % 3 if i % 2 else 0
        rows += [(2 * i, (centres[label] + v).tolist(), label), (2 * i + 1, (centres[label] + v + 0.25 * rng.normal(size=64)).tolist(), label)]
    df = vectors(spark, rows, False)
    want = {}
    for label in range(3):
        ids = [r[0] for r in rows if r[2] == label]
        x = np.array([r[1] for r in rows if r[2] == label], np.float32).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        want |= dict(zip(ids, ((x @ x.T >= 0.93).sum(axis=1) - 1).tolist()))
    got = {r.vec_id: r.n_links for r in embedding_dedup(df, row_cost=1.0, block=256).collect()}
    assert sum(want.values()) > 3000 and 0.9 * sum(want.values()) <= sum(got.values())
    assert all(got[k] <= n for k, n in want.items())
    classes = df.select(F.monotonically_increasing_id().alias("cid"), F.col("label").cast("long").alias("group"), F.lit(1).cast("long").alias("n"),
                        F.col("embedding").cast("array<double>").alias("v"), F.xxhash64("vec_id").alias("k1"), F.lit(0).cast("long").alias("k2"))
    buckets = embedding._dealt(*embedding._index(classes, 64, len(rows), 0.93, 2_000_000, 1.0), 64, "float32").groupBy("group", "place", "key").count()
    met = buckets.agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]
    every = sum(n * (n - 1) / 2 for n in Counter(r[2] for r in rows).values())
    print("candidates over pairs of a label:", spread, met / every)
    assert met < (0.2 if spread < 1 else 0.6) * every


def test_embeddings_empty_and_few_dimensions(spark):
    assert embedding_dedup(vectors(spark, [])).collect() == []
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [0.0, 1.0], 1)]
    assert {(r.vec_id, r.n_links, r.component_id) for r in embedding_dedup(vectors(spark, rows)).collect()} == {(1, 1, 1), (2, 1, 1), (3, 0, 3)}
    assert [(r.n_links, r.component_id) for r in embedding_dedup(vectors(spark, [(1, None, 1)])).collect()] == [(0, 1)]


def test_normalised(spark):
    df = spark.createDataFrame([("a \t\n\x0b\f\r b\x1cc\u00a0d",), (None,)], "t string")
    assert [r[0] for r in df.select(normalised(F.col("t"))).collect()] == ["ab\x1cc\u00a0d", ""]


def test_spans_settle_in_any_partitioning(spark):
    rows = rows_of(brute.awkward(spark, clashes=False))
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = Counter(tuple(r) for r in substring_dedup(df).collect())
        assert got == brute.substring(rows)
    assert repeated_spans(df).count() == len(rows)
