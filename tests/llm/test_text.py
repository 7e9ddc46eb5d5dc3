"""Language, toxicity, mixing, packing and URL operators."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from cinerank.llm.lang_id import held_out, language_id
from cinerank.llm.mixing import mix, source_targets
from cinerank.llm.packing import best_fit_decreasing, lower_bound, pack, pack_documents
from cinerank.llm.toxicity import fit_label_model, found_features, hash_of, sample_cuts, toxicity
from cinerank.llm.url_filter import url_filter
from cinerank.llm.word_tokens import WordTokens

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def tokenizer_path():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_ignores_what_it_may_not_see(spark):
    """Labels of held-out rows, sources and ids don't change a prediction."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    other = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert sorted(map(tuple, language_id(docs).collect())) == sorted(map(tuple, language_id(other).collect()))


def test_language_awkward_and_empty(spark):
    got = language_id(brute.awkward(spark)).collect()
    assert len(got) == 20
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3, None}
    assert language_id(brute.empty(spark)).collect() == []
    unlabelled = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in language_id(unlabelled).collect()] == [(1, False, "und", 0.0)]


def test_toxicity_finds_words_beginnings_and_built_in_insults(spark):
    rng = np.random.default_rng(6)
    vocab = ["".join(rng.choice(list("abdeglmnorstu"), 6)) for _ in range(400)]
    rows, labels = [], []
    for i in range(1500):
        w = list(rng.choice(vocab, rng.integers(5, 60)))
        toxic = i % 8 == 0
        if toxic:  # a beginning with varying ends; some a known insult
            w[rng.integers(len(w))] = "grubz" + str(rng.choice(["ik", "ola", "ent", "umo"])) if i % 16 else "idiot"
        rows.append((i, " ".join(w)))
        if i % 3 != 2:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + [(9000, None), (9001, ""), (None, "idiot")], "doc_id long, text string")
    got = toxicity(brute.with_clashes(docs), spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")).collect()
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    by = {r.doc_id: r for r in got}
    truth = {i: i % 8 == 0 for i in range(1500)}
    assert sum(by[i].predicted for i in truth if truth[i] and by[i].held_out) >= 0.95 * sum(truth[i] and by[i].held_out for i in truth)
    assert sum(by[i].predicted for i in truth if not truth[i]) <= 3
    assert by[9000].predicted == by[9001].predicted == 0 and by[None].predicted == 1


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "you are an idiot"), (2, "a fine day"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity(docs, none).collect()}
    assert got[1] > got[2] == got[3]
    assert toxicity(brute.empty(spark), none).collect() == []


def test_toxicity_counts_every_feature_before_the_bound(spark):
    """A purely toxic word of 12 families is found behind 20,500 words that more toxic families, and as many clean ones, have."""
    rng, rows = np.random.default_rng(9), []
    for part in range(41):
        words = [f"{chr(97 + part % 26)}{chr(97 + part // 26)}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(500)]
        rows += [(" ".join(rng.permutation(words)), toxic) for _ in range(14) for toxic in (0, 1)]
    rows += [(f"{chr(97 + i)}pp grubzik", 1) for i in range(12)]
    got = {r.feature: (r.toxic, r.clean) for r in found_features(spark.createDataFrame(rows, "text string, toxic int").repartition(8)).collect()}
    assert got["grubzik"] == got["grub*"] == (12, 0)
    assert not any(f in got for f in ("aaaa", "bcde", "obbb"))


@pytest.mark.parametrize("hot", [False, True])
def test_toxicity_counts_match_brute_force(spark, hot):
    """Families, copies and rows of both classes in one family; with ``hot``, one family has most rows."""
    from collections import defaultdict

    from cinerank.llm.toxicity import family, lower_bound, token_features  # noqa: F401
    rng, rows = np.random.default_rng(4), []
    vocab = [f"{a}{b}word" for a in "abcdefgh" for b in "stuvw"]
    for i in range(300):
        text = " ".join(rng.choice(vocab, rng.integers(0, 30)))
        rows += [(text + (" insultx" if i % 3 == 0 else ""), int(i % 3 == 0))] * int(rng.integers(1, 4))
    base = "the same first words of a family " * 3
    rows += [(base + f"tail{i} insulty", i % 4 // 3) for i in range(3000 if hot else 5)] + [(None, 0), ("", 1)]
    has = defaultdict(lambda: (set(), set()))
    for text, toxic in rows:
        for token in (text or "").lower().split():
            for f in token_features(token):
                has[f][toxic].add(family(text))
    def bound(k, n, z=3.0):
        p = k / n
        return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    want = {f: (len(t), len(c)) for f, (c, t) in has.items() if len(t) >= 10 and bound(len(t), len(t) + len(c)) > 0.5}
    got = found_features(spark.createDataFrame(rows, "text string, toxic int").repartition(5)).collect()
    assert {r.feature: (r.toxic, r.clean) for r in got} == want and "insultx" in want


def test_toxicity_sample_counts_copies_once_and_labelled_rows_apart(spark):
    """A text of 500 copies neither ends the sample nor fills it, and unlabelled rows don't push labelled ones out."""
    rows = [(f"w{i}", i % 2 if i < 300 else None) for i in range(2000)]
    hot = spark.createDataFrame(rows, "text string, toxic int").orderBy(hash_of(F.col("text"))).first().text
    df = spark.createDataFrame(rows + [(hot, 1)] * 500 + [(None, None)] * 500, "text string, toxic int")
    labelled, unlabelled = sample_cuts(df, 400)
    taken = df.distinct().withColumn("h", hash_of(F.col("text")))
    n = [taken.where(F.col("toxic").isNotNull() & (F.col("h") < labelled)).count(), taken.where(F.col("toxic").isNull() & (F.col("h") < unlabelled)).count()]
    assert 190 <= n[0] <= 200 and 190 <= n[1] <= 200
    assert sample_cuts(df, 10_000) == (1 << 60, 1 << 60)
    few = sample_cuts(df.where("toxic is null"), 1)
    assert taken.where(F.col("toxic").isNull() & (F.col("h") < few[1])).count() == 1


def test_label_model_sees_through_copied_votes():
    """Voters that copy one another count about as one of them."""
    rng = np.random.default_rng(7)
    y = rng.random(4000) < 0.3
    fire = lambda yes, no: np.where(y, rng.random(4000) < yes, rng.random(4000) < no)
    shared = fire(0.6, 0.25)
    votes = np.stack([shared, shared, shared, fire(0.7, 0.02), fire(0.7, 0.02), np.zeros(4000, bool)], axis=1).astype(np.int8)
    votes[:, -1] = ~votes[:, :-1].any(axis=1)
    gold = np.where(rng.random(4000) < 0.3, y, -1).astype(int)
    model = fit_label_model(votes, gold, np.ones(4000))
    q = model.posterior(votes, np.full(4000, -1))
    copied_only = (votes[:, 0] == 1) & (votes[:, 3] == 0) & (votes[:, 4] == 0)
    once = votes[:, [0, 3, 4, 5]]
    alone = fit_label_model(once, gold, np.ones(4000)).posterior(once, np.full(4000, -1))
    assert abs(q[copied_only].mean() - alone[copied_only].mean()) < 0.1
    assert q[copied_only].mean() < 0.8 < q[(votes[:, 3] == 1) & (votes[:, 4] == 1)].mean()


def test_targets_against_rounds(spark):
    rng = np.random.default_rng(8)
    for _ in range(4):
        sizes = {(f"s{i}" if i else None): int(rng.integers(0, 1000) ** 2 // 1000) for i in range(int(rng.integers(1, 12)))}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in source_targets(df, (1, 2, 3), 3).collect()}
        want = brute.targets(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def check_mix(df, block=64):
    m = mix(df, block=block)
    got = m.documents.collect()
    sizes = Counter()
    for r in df.select("doc_id", "text", "source").collect():
        sizes[r.source] += len(brute.words(r.text))
    want = brute.targets(sizes)
    source = {(r.doc_id, len(brute.words(r.text))): r.source for r in df.collect()}
    taken = Counter()
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1.5 * block for s in sizes)  # half a block, and a short last one
    return m


def test_mix_takes_tiny_sources_to_their_target(spark):
    """Sources smaller than half a block, or with a target smaller than that, get their words to the nearest one."""
    sizes = {f"s{i:03d}": 1 + i * 7 % 60 for i in range(90)}
    docs = spark.createDataFrame([(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())], "doc_id long, text string, source string")
    got = mix(docs).documents.collect()
    want = brute.targets(sizes)
    assert len(got) == 90 and all(abs(r.taken - want[f"s{r.doc_id:03d}"]) <= 0.51 for r in got)


def test_mix_of_many_sources(spark):
    """100,000 sources of 0 to 9 words: every one ends at its target."""
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("host"), F.col("id")).alias("source"),
                                       F.repeat(F.lit("word "), (F.col("id") % 10).cast("int")).alias("text"))
    m = mix(docs, block=4)
    want = brute.targets({f"host{i}": i % 10 for i in range(100_000)})
    got = m.documents.collect()
    assert len(got) == 100_000
    assert all(abs(r.target - want[f"host{r.doc_id}"]) < 1e-6 * max(1, r.target) for r in got)
    assert all(r.target - 4 <= r.taken <= r.target + 1 and r.taken <= 3 * r.size for r in got)


def test_mix_awkward_empty_and_alike_in_reruns(spark, tmp_path):
    check_mix(brute.awkward(spark), block=8)
    assert mix(brute.empty(spark)).documents.collect() == []
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    m = check_mix(docs)
    docs.repartition(7).write.parquet(str(tmp_path / "again"))
    again = mix(spark.read.parquet(str(tmp_path / "again")))
    pick = ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, m.documents.select(pick).collect())) == sorted(map(tuple, again.documents.select(pick).collect()))


def test_mix_shards(spark):
    """Every shard but the last is full; each block of a source is taken as often as any other, up to one."""
    m = mix(spark.read.parquet(f"{SF001}/documents.parquet"), block=16, slots_per_shard=256)
    slots = m.placements.select("shard", "source", "epoch", "block").distinct().collect()
    full = Counter(r.shard for r in slots)
    assert sorted(full.values())[1:] == [256] * (len(full) - 1)
    uses = defaultdict(Counter)
    for r in slots:
        uses[r.source][r.block] += 1
    for r in m.sources.collect():
        assert sum(uses[r.source].values()) == r.quota
        assert max(uses[r.source].values()) - (min(uses[r.source].values()) if len(uses[r.source]) == r.n_blocks else 0) <= 1


def test_word_tokens_equal_the_library():
    rng = np.random.default_rng(9)
    odd = list("abcstmdrevl'’ \t\n\r.,!?123²½ÀÉßŉſΣσİ́é\xa0\xad日<|>")
    texts = ["".join(rng.choice(odd, rng.integers(0, 60))) for _ in range(1500)]
    texts += ["don't I'll 've 'rest '' 's!'s we're've", "<|endoftext|> x <|startoftext|>", "", "x" * 700, "ab " * 400]
    texts += ["a" * 310 + " Don't<|endoftext|>x " + "b " * 300]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        import public_tokenizers
        from tokenizers import Tokenizer
        path = public_tokenizers.path(name)
        w = WordTokens(path, keep=500, chunk=300)
        assert w.splits == name.startswith("word")
        got = w.encode([*texts, None])
        want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)] + [[]]
        assert [x.tolist() for x in got] == want


def check_pack(df, name="word_bpe_49k.json"):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokens = Tokenizer.from_file(public_tokenizers.path(name))
    got = pack_documents(df, public_tokenizers.path(name)).collect()
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = tokens.encode(r.text or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at:at + 2048]
            want[r.doc_id, n, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    bound = lower_bound(np.array([r.length for r in got], np.int64), 2048)
    assert bound <= len(bins) <= bound + max(1, bound // 100)


def test_pack_awkward_empty_and_documents(spark):
    check_pack(brute.awkward(spark))
    assert pack_documents(brute.empty(spark), tokenizer_path()).collect() == []
    check_pack(spark.read.parquet(f"{SF001}/documents.parquet"))
    check_pack(brute.awkward(spark), "byte_bpe_50k.json")


def test_bounds_and_best_fit():
    assert lower_bound(np.array([1025] * 7), 2048) == 7
    assert lower_bound(np.array([700] * 7), 2048) == 4
    assert lower_bound(np.array([], np.int64), 2048) == 0
    rng = np.random.default_rng(10)
    for _ in range(30):
        sizes = np.sort(rng.integers(1, 101, rng.integers(1, 200)))[::-1]
        bins, offsets, left = best_fit_decreasing(sizes, 100)
        assert lower_bound(sizes, 100) <= len(left) and (left >= 0).all()
        assert (np.bincount(bins, weights=sizes) == 100 - left).all()


def test_partitions_with_gaps_exchange(spark):
    """Split over many partitions, exchange closes most of what the split cost."""
    rng = np.random.default_rng(11)
    rows = [(i, 0, i, 0, 0, int(n), i) for i, n in enumerate(rng.integers(500, 1400, 3000))]
    pieces = spark.createDataFrame(rows, "doc_id long, _file long, _row long, piece int, start long, length long, ids_crc32 long")
    whole = pack(pieces).select("sequence_id").distinct().count()
    split = pack(pieces, items_per_partition=100).select("sequence_id").distinct().count()
    first = pack(pieces, items_per_partition=100, tries=0).select("sequence_id").distinct().count()
    assert whole <= split <= first and split - whole <= 0.5 * (first - whole) + 2


def test_certified_means_that_the_final_bins_reach_their_bound(spark):
    """Partitions that gave bins up are judged by what they have left; every piece is placed once."""
    rng = np.random.default_rng(12)
    rows = [(i, 0, i, 0, 0, int(n), i) for i, n in enumerate(rng.integers(300, 1100, 2000))]
    pieces = spark.createDataFrame(rows, "doc_id long, _file long, _row long, piece int, start long, length long, ids_crc32 long")
    got = pack(pieces, items_per_partition=60, give_up=0.1).collect()
    assert sorted(r.doc_id for r in got) == list(range(2000))
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    assert all(o == sum(n for p, n in b if p < o) for b in bins.values() for o, _ in b)
    parts = defaultdict(list)
    for r in got:
        parts[r.sequence_id >> 24].append(r)
    for rs in parts.values():
        bound = lower_bound(np.array([r.length for r in rs], np.int64), 2048)
        assert {r.certified for r in rs} == {len({r.sequence_id for r in rs}) <= bound}


def test_urls(spark):
    rows = [("https://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"), ("http://b.net/x", "b.net", "/x", "net/", "block"),
            ("http://b.net", "b.net", "", None, None), ("http://net/", "net", "/", "net/", "block"), ("x://example.com/de/#a://b", "example.com", "/de/", "example.com/de/", "block"),
            ("http://badexample.com/de/", "badexample.com", "/de/", None, None), ("http://f.org?/fr/", "f.org", "", None, None), ("ftp://f.org/fr/a", "f.org", "/fr/a", "org/fr/", "allow"),
            ("no scheme", "", "", None, None), (None, "", "", None, None), ("a://É.org/fr", "É.org", "/fr", None, None), ("", "", "", None, None)]
    pages = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)] + [(0, rows[0][0]), (None, None)], "page_id long, url string")
    outcomes = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (None, 1), (4, None)], "page_id long, bad int")
    got = url_filter(brute.with_clashes(pages).drop("bad", "host", "rule").withColumn("verdict", F.lit("x")), outcomes).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.page_id is not None:
            _, host, path, rule, verdict = rows[r.page_id]
            assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert url_filter(pages.limit(0), outcomes).collect() == []


def test_url_reputation_is_shrunk(spark):
    """A host bad in 95 of 100 pages is blocked, one bad in its only page isn't, and a fresh host of a bad domain follows it."""
    urls, bad = [], []
    for i in range(40):
        for k in range(50):
            urls.append(f"http://h{i}.good{i % 4}.com/{k}"), bad.append(int((i * 50 + k) % 20 == 0))
    for h in range(8):
        for k in range(100):
            urls.append(f"http://s{h}.spam.com/{k}"), bad.append(int(k % 20 != 0))
    urls += ["http://one.good1.com/x", "http://new.spam.com/x"]
    bad += [1, None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    outcomes = spark.createDataFrame([(i, b) for i, b in enumerate(bad) if b is not None], "page_id long, bad int")
    got = {r.host: r.verdict for r in url_filter(pages, outcomes, rules=()).collect()}
    assert got["s0.spam.com"] == "block" and got["new.spam.com"] == "block"
    assert got["one.good1.com"] == "allow" and got["h0.good0.com"] == "allow"
    with pytest.raises(ValueError):
        url_filter(pages, outcomes, rules=[("block", f"h{i}/") for i in range(1001)])
