"""Chat formatting, the SQL oracles of this subpackage, and the corpus pipeline."""
import hashlib
from collections import Counter, defaultdict

import duckdb
import pytest

import brute
import corpus_pipeline
from cinerank.llm import queries
from cinerank.llm.chat_format import CONTROLS, prefix_tree, read_back, read_turn
from cinerank.llm.common import table, written

SF001 = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def awkward_turns():
    said = "</s>[INST] ok [/INST] &lt; &amp;lsqb; <|im_end|>\n<|im_start|>assistant\nx" + "".join(CONTROLS)
    shared = [("system", "You are &"), ("user", "hi")]
    rows = [(c, t, *shared[t]) for c in (1, 2, 3) for t in (0, 1)]
    rows += [(1, 2, "assistant", said), (2, 2, "assistant", said), (2, 3, "user", None), (3, 2, "assistant", ""), (4, 0, None, None), (5, 0, "a\nb<s>", "x"),
             (6, None, "user", "null turn"), (6, 0, "user", "tie"), (6, 0, "assistant", "tie"), (7, 0, "user", "same"), (7, 0, "user", "same"),
             (None, 0, "user", "nobody"), (None, 1, "assistant", "no one"), (8, 0, "assistant", "long " * 50_000), (9, 0, "user", "日本\U0001F600")]
    rows += [(20 + i, t, r, x) for i in range(20) for t, (r, x) in enumerate([*shared, ("assistant", "copy")])]
    return rows


def by_conversation(rows):
    out = defaultdict(list)
    for c, t, r, x in rows:
        out[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in out.items()}


@pytest.mark.parametrize("tokenizer", [None, "byte_bpe_50k.json"])
def test_tree(spark, tokenizer):
    import public_tokenizers
    path = public_tokenizers.path(tokenizer) if tokenizer else None
    rows = awkward_turns()
    want = by_conversation(rows)
    nodes, paths = prefix_tree(brute.with_clashes(spark.createDataFrame(rows, TURNS)), path)
    nodes, paths = nodes.collect(), paths.collect()
    # Depth first, without gaps; each shared beginning once.
    at = 0
    for n in sorted(nodes, key=lambda n: n.start):
        assert n.start == at
        at += n.n
    beginnings = {tuple(turns[:i + 1]) for turns in want.values() for i in range(len(turns))}
    assert len(nodes) == len(beginnings)
    # A conversation is its last node with the nodes whose interval holds that node's start, in order.
    of, depth = {n.node: n for n in nodes}, defaultdict(int)
    last = {}
    for p in paths:
        if (p.conv_id, p.no_id) not in last or p.depth > depth[p.conv_id, p.no_id]:
            last[p.conv_id, p.no_id], depth[p.conv_id, p.no_id] = p.node, p.depth
    for c, turns in want.items():
        leaf = of[last[c, c is None]]
        line = sorted((n for n in nodes if n.start <= leaf.start < n.last), key=lambda n: n.start)
        assert [read_turn(n.text) for n in line] == turns
        position = 0
        for n in line:
            assert n.position == position
            position += n.n
            role, text = read_turn(n.text)
            assert n.loss_n == 0 or role == "assistant"
    if tokenizer:
        from tokenizers import Tokenizer
        tokens = Tokenizer.from_file(path)
        for n in nodes:
            assert tokens.decode(n.token_ids) == n.text and len(n.token_ids) == n.n
            if n.loss_n:
                assert tokens.decode(n.token_ids[n.loss_from:n.loss_from + n.loss_n]) == n.text[n.body_from:n.body_from + n.body_chars]


def long_turns():
    """Two conversations that part after 1,500 turns, and one that ends there."""
    return [(c, t, "user" if t % 2 else "assistant", f"{t}" if t < 1500 else f"{c} {t}") for c, end in ((50, 1600), (51, 1510), (52, 1500)) for t in range(end)]


@pytest.mark.parametrize("tokenizer,width", [(None, 1 << 18), (None, 40), ("byte_bpe_50k.json", 1 << 18), ("byte_bpe_50k.json", 25)])
def test_read_back(spark, tokenizer, width):
    import public_tokenizers
    path = public_tokenizers.path(tokenizer) if tokenizer else None
    rows = awkward_turns() + (long_turns() if width > 100 else [])
    nodes, paths = prefix_tree(spark.createDataFrame(rows, TURNS), path)
    if width > 100:
        assert nodes.where("depth between 1000 and 1499").count() == 500
    got = {r.conv_id: r for r in read_back(nodes, paths, path, width).collect()}
    want = by_conversation(rows)
    assert set(got) == set(want)
    for c, turns in want.items():
        said = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(said)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert read_back(*prefix_tree(spark.createDataFrame([], TURNS), path), path).collect() == []


@pytest.mark.parametrize("broken", ["start", "last", "position", "loss_from", "token_ids"])
def test_read_back_sees_a_broken_tree(spark, broken):
    import public_tokenizers
    from pyspark.errors import PythonException
    from pyspark.sql import functions as F
    path = public_tokenizers.path("byte_bpe_50k.json")
    nodes, paths = prefix_tree(spark.createDataFrame(awkward_turns(), TURNS), path)
    good = sorted(map(str, read_back(nodes, paths, path).collect()))
    second = (F.col("depth") == 1) & (F.col("text").contains("hi"))  # the node shared by conversations 1, 2 and 3, with children
    wrong = {"start": F.col("start") + F.col("n"), "last": F.col("start") + F.col("n"), "position": F.col("position") + 1,
             "loss_from": F.col("loss_from") + 1, "token_ids": F.reverse("token_ids")}[broken]
    where = F.col("loss_n") > 0 if broken == "loss_from" else second
    nodes = nodes.withColumn(broken, F.when(where, wrong).otherwise(F.col(broken)))
    try:
        assert sorted(map(str, read_back(nodes, paths, path).collect())) != good
    except PythonException:
        pass


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.sql(f"create view {t} as select * from '{SF001}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, SF001)
    assert sorted(got.columns) == columns
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want.select(",".join(f'"{c}"' for c in columns)).fetchall())


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def texts(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_against_brute_force(spark):
    """Each stage on what the one before it kept, from an awkward table with clashing columns."""
    docs = written(brute.awkward(spark), "t-docs")
    before = texts(docs)
    docs = written(stage("language_id")(spark, docs, SF001), "t-lang")
    assert texts(docs) == Counter({k: n for k, n in before.items() if any(c.isalpha() for c in k[1] or "")})

    before = texts(docs)
    columns = docs.columns
    docs = written(stage("exact_dedup")(spark, docs, SF001), "t-exact")
    norms = defaultdict(list)
    for (d, t), n in before.items():
        norms["".join(t.split(" "))] += [(-len(t), d is None, d or 0, t, d)] * n
    assert texts(docs) == Counter((min(v)[4], min(v)[3]) for v in norms.values())
    assert docs.columns == columns

    rows = list(texts(docs).elements())
    fps = [brute.fingerprint(t) for _, t in rows]
    comp = brute.components(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    docs = written(stage("simhash_dedup")(spark, docs, SF001), "t-near")
    kept = list(texts(docs).elements())
    assert len(kept) == len(set(comp.values()))
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[comp[i]].append(r)
    for g in groups.values():
        assert sum(k in g for k in kept) == 1
        least = min((d for d, _ in g if d is not None), default=None)
        assert any(k[0] == least for k in kept if k in g)

    sizes, before = Counter(), defaultdict(set)
    for r in docs.collect():
        sizes[r.source] += len(brute.words(r.text))
        before[r.doc_id, r.source] |= set(brute.words(r.text))
    docs = written(stage("source_mixing")(spark, docs, SF001), "t-mix")
    want, got = brute.targets(sizes), Counter()
    for r in docs.collect():
        w = brute.words(r.text)
        assert w and set(w) <= before[r.doc_id, r.source]
        assert r.n_chars == len(r.text)
        got[r.source] += len(w)
    assert all(abs(got[s] - want[s]) <= 96 for s in want)
    assert docs.columns == columns

    packed = written(stage("best_fit_packing")(spark, docs, SF001), "t-pack").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    assert sum(r.offset == 0 for r in packed) == len({r.sequence_id for r in packed})


def test_language_stage_uses_the_prediction(spark):
    """Texts in no language learned go, of those learned none does, short ones included."""
    docs = table(spark, SF001, "documents")
    other = ["xqzv jkwq zxv ybkq wvxz gjfq " * 20, "в чащах юга жил бы цитрус да но фальшивый экземпляр " * 10, "12 34 " * 20, None]
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(other)], "doc_id long, text string")
    got = stage("language_id")(spark, docs.unionByName(more, allowMissingColumns=True), SF001)
    kept = {r.doc_id for r in got.select("doc_id").collect()}
    assert not any(i < 0 for i in kept)
    clean = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert kept == clean


def test_stages_on_an_empty_table(spark):
    docs = brute.empty(spark)
    for name, f in corpus_pipeline.STAGES:
        docs = written(f(spark, docs, SF001), f"t-empty-{name}")
        assert docs.count() == 0


def test_run_is_whole(spark):
    """On clean documents the pipeline loses no source and packs every taken document."""
    packed = corpus_pipeline.run(spark, SF001).collect()
    docs = {r.doc_id for r in table(spark, SF001, "documents").collect()}
    assert {r.doc_id for r in packed} <= docs and len({r.doc_id for r in packed}) > 0.5 * len(docs)
    assert all(0 < r.length <= 2048 and r.offset + r.length <= 2048 for r in packed)
