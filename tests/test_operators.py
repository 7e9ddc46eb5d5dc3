"""Properties and cross-checks of split, permutation, scoring, metrics and recommendation."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.model.score import Model, score_arrow, score_expr
from cinerank.model.spec import ModelSpec, init_params
from cinerank.operators import evaluate as EV
from cinerank.operators import recommend as R
from cinerank.operators import split as S
from cinerank.plans.q_features import fixture_features
from cinerank.plans.q_model import fixed_model
from cinerank.sources.fixtures import load_fixture, load_requests
from conftest import SF001


@pytest.fixture(scope="module")
def feats(spark):
    return fixture_features(spark, SF001).cache()


def test_hash_split_is_a_partition(feats):
    train, test = S.hash_split(feats)
    n, a, b = feats.count(), train.count(), test.count()
    assert a + b == n and 0.7 < a / n < 0.9
    assert train.join(test, S.RATING_KEY, "left_semi").count() == 0


def test_hash_split_stable_under_repartitioning(feats):
    t1, _ = S.hash_split(feats)
    t2, _ = S.hash_split(feats.repartition(7))
    assert t1.exceptAll(t2).count() == 0 and t2.exceptAll(t1).count() == 0


@pytest.mark.parametrize("col", ["age_idx", "genre_mask"])
def test_permute_keeps_multiset_and_other_columns(feats, col):
    perm = S.permute_column(feats, col, S.RATING_KEY)
    assert perm.count() == feats.count()
    assert feats.groupBy(col).count().exceptAll(perm.groupBy(col).count()).count() == 0
    others = [c for c in feats.columns if c not in (col, "genres")]
    assert feats.select(*others).exceptAll(perm.select(*others)).count() == 0
    moved = perm.join(feats.select(*S.RATING_KEY, "rating", F.col(col).alias("_orig")),
                      S.RATING_KEY + ["rating"]).filter(F.col(col) != F.col("_orig")).count()
    assert moved > 0


def test_sample_cap_is_exact_top_by_hash(feats):
    capped = S.sample_cap(feats, 500, S.RATING_KEY)
    assert capped.count() == 500
    brute = (feats.withColumn("_h", S.hash_int(S.key_string(S.RATING_KEY, 42), 15))
             .orderBy("_h", *feats.columns).limit(500).drop("_h"))
    assert capped.exceptAll(brute).count() == 0


@pytest.mark.parametrize("model_type", ["ncf", "neumf"])
def test_expression_scorer_equals_arrow_scorer(spark, feats, model_type):
    spec = ModelSpec(model_type)
    model = Model(spec, init_params(spec, seed=7, out_bias=3.0))
    sample = feats.limit(300)
    both = score_expr(score_arrow(sample, model, "pa", "ra"), model, "pe", "re")
    d = both.agg(F.max(F.abs(F.col("ra") - F.col("re")))).first()[0]
    assert d <= 1e-9


@pytest.mark.parametrize("hidden", [[4], [64, 32]])  # rows one by one; the distinct keys of a batch
def test_arrow_scorer_on_odd_rows(spark, hidden):
    """Repeated keys, a null mask (no genre), outputs under, over and of no number, no rows."""
    spec = ModelSpec("neumf", embed_dim=4, hidden_dims=hidden)
    rows = [(0, 0, 0, 0, 3, "a"), (1, 6, 20, 10, (1 << 18) - 1, "b"), (0, 0, 0, 0, 3, "c"), (1, 2, 3, 4, None, "d"), (1, 2, 3, 4, 0, None)]
    df = spark.createDataFrame(rows, "gender_idx int, age_idx int, occ_idx int, zip_idx int, genre_mask int, x string").coalesce(1)
    for bias in (3.0, -50.0, 50.0, float("nan")):
        model = Model(spec, init_params(spec, seed=7, out_bias=bias))
        got = score_arrow(df, model, "score", "raw").collect()
        assert [r.x for r in got] == [r[-1] for r in rows]
        want = model.predict_np(*(np.array([r[k] or 0 for r in rows]) for k in range(5)), clamp=False)
        assert np.allclose([r.raw for r in got], want, rtol=1e-12, equal_nan=True)
        assert np.array_equal([r.score for r in got], np.clip([r.raw for r in got], 1.0, 5.0), equal_nan=True)
    assert score_arrow(df.limit(0), model, "score").collect() == []


def test_fixed_scores_come_from_python_as_one_number(spark):
    """no struct is made for a row's answer, and the text of its genres is looked up."""
    import __spark_entry__ as entry
    plan = entry.queries()["score_neumf_fixed"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and plan.count("ArrowEvalPython") == 1
    assert "pythonUDF0#" in plan and "].raw" not in plan and ".raw AS" not in plan and "bin(" not in plan


def test_metrics_match_regression_evaluator(feats):
    from pyspark.ml.evaluation import RegressionEvaluator
    pred = score_arrow(feats, fixed_model("ncf"), "prediction").withColumn("rating", F.col("rating").cast("double"))
    m = EV.regression_metrics(pred).first()
    for name in ("rmse", "mse", "mae"):
        ev = RegressionEvaluator(predictionCol="prediction", labelCol="rating", metricName=name).evaluate(pred)
        assert abs(ev - m[name]) < 1e-9


def test_recommend_matches_naive_loop(spark):
    """Bulk recommend (genre-set plan) against a per-request loop over all movies."""
    import pandas as pd
    from cinerank.model import kernel as K
    from cinerank.schema import AGE_CODES, GENRES
    model = fixed_model("ncf")
    reqs = load_requests(spark, SF001)
    movies = load_fixture(spark, SF001).movies
    got = R.recommend(reqs, movies, model).fillna(-1, ["request_id"]).toPandas()
    mv = movies.toPandas()
    mv["gset"] = mv["genres"].apply(lambda s: {g.strip() for g in str(s).split("|")})
    mv["mask"] = mv["gset"].apply(lambda s: sum(1 << i for i, g in enumerate(GENRES) if g in s))
    valid = R.validate_requests(reqs).filter("reject_reason is null").fillna(-1, ["request_id"]).toPandas()
    assert len(valid) > 0
    expected = []
    for r in valid.itertuples():
        want = set(r.genre_list)
        cand = mv[mv["gset"].apply(lambda s: bool(s & want))].copy()
        n = len(cand)
        zip_idx = int(r.zip_code.strip()[0]) if r.zip_code and r.zip_code.strip()[:1].isdigit() else 10
        cand["score"] = model.predict_np(np.full(n, 0 if r.gender == "M" else 1),
                                         np.full(n, AGE_CODES.index(r.age)), np.full(n, r.occupation),
                                         np.full(n, zip_idx), cand["mask"].to_numpy())
        top = cand.sort_values(["score", "movie_id"], ascending=[False, True]).head(r.top_n)
        expected += [(r.request_id, i + 1, int(t.movie_id)) for i, t in enumerate(top.itertuples())]
    got_keys = sorted(zip(got["request_id"], got["rank"], got["movie_id"]))
    assert got_keys == sorted(expected)


def test_equal_and_null_ids_get_whole_answers(spark):
    """Requests are told apart by what they ask; answered, empty and rejected ones all come back."""
    rows = [(1, "M", 25, 3, "123", ["Drama"], 3), (1, "F", 25, 3, "123", ["Western"], 3), (None, "M", 25, 3, "9", ["Drama"], 2),
            (None, "M", 25, 3, "9", ["Drama"], 2), (2, "M", 25, 99, "9", ["Drama"], 2), (3, "M", 25, 3, "9", ["Horror"], 2)]
    movies = spark.createDataFrame([(i, f"t{i}", g) for i, g in enumerate(["Drama", "Western", "Drama|War", "Drama", "Western"])],
                                   "movie_id int, title string, genres string")
    got = R.recommend_responses(spark.createDataFrame(rows, R.REQUEST_SCHEMA), movies, fixed_model("ncf")).collect()
    seen = sorted((str(r.request_id), r.status, str(r.reject_reason), r.gender_label, len(r["items"]), {i.genres.split("|")[0] for i in r["items"]} or "")
                  for r in got)
    assert len(got) == 6
    assert [s[:5] for s in seen] == [("1", "answered", "None", "Female", 2), ("1", "answered", "None", "Male", 3), ("2", "rejected", "occupation_range", "Male", 0),
                                     ("3", "empty", "None", "Male", 0), ("None", "answered", "None", "Male", 2), ("None", "answered", "None", "Male", 2)]
    assert seen[0][5] == {"Western"} and seen[1][5] == {"Drama"}


def test_dates_do_not_follow_the_session_time_zone(spark):
    from cinerank.operators import explore as X
    ratings = spark.createDataFrame([(1, 1, 5.0, 0), (1, 2, 4.0, 31 * 86400 - 1), (2, 1, 3.0, 31 * 86400), (2, 2, 3.0, 120 * 86400)],
                                    "user_id int, movie_id int, rating float, ts long")
    zone = spark.conf.get("spark.sql.session.timeZone")
    seen = []
    try:
        for z in ("UTC", "America/Los_Angeles", "Pacific/Auckland"):
            spark.conf.set("spark.sql.session.timeZone", z)
            s = X.dataset_summary(ratings).first()
            seen.append((str(s.first_date), str(s.last_date), [(str(r.month_end), r.n_ratings) for r in X.monthly_ratings(ratings).collect()]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seen[0] == seen[1] == seen[2]
    assert seen[0] == ("1970-01-01", "1970-05-01", [("1970-01-31", 2), ("1970-02-28", 1), ("1970-03-31", 0), ("1970-04-30", 0), ("1970-05-31", 1)])


def test_global_position_over_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).selectExpr("(id * 7919) % 1000 as k", "id")
    got = S.global_position(df, [F.col("k"), F.col("id")], "pos").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1, 5001)) and [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)


def test_validate_requests_reasons(spark):
    rows = [(1, "M", 25, 3, "123", "Drama", 5), (2, "M", 25, 21, "123", "Drama", 5),
            (3, "M", 25, 3, "123", "", 5), (4, "M", 25, 3, "123", "Drama", 0),
            (5, "X", 25, 3, "123", "Drama", 5), (6, "F", 30, 3, "123", "Drama", 5),
            (7, "F", 25, 3, "123", "Drama|Polka", 5), (8, "F", 25, 3, "123", "A|B|C|D", 5),
            (9, "F", 25, 3, "123", "Drama", None), (10, "F", 25, 3, None, "Drama", 5)]
    piped = spark.createDataFrame(rows, "request_id long, gender string, age int, occupation int, zip_code string, genres string, top_n int")
    df = spark.createDataFrame([(*r[:5], r[5].split("|") if r[5] else [], r[6]) for r in rows], R.REQUEST_SCHEMA)
    as_list = [(r.request_id, r.reject_reason) for r in R.validate_requests(df).collect()]
    assert as_list == [(r.request_id, r.reject_reason) for r in R.validate_requests(piped).collect()]
    got = {r.request_id: (r.reject_reason, r.top_n) for r in R.validate_requests(df).collect()}
    assert got[1] == (None, 5) and got[9] == (None, 10)
    assert got[10][0] == "zip_missing"
    assert [got[i][0] for i in range(2, 9)] == ["occupation_range", "genre_count", "top_n_range",
                                                "gender_unknown", "age_unknown", "genre_unknown",
                                                "genre_count"]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 97, 1000, 4096, 70_001])
def test_bijection_permutes_positions(spark, n):
    got = [r[0] for r in spark.range(n).select(S.bijection("id", n, 42, "x")).collect()]
    assert sorted(got) == list(range(n))
    if n >= 1000:
        other = [r[0] for r in spark.range(n).select(S.bijection("id", n, 42, "y")).collect()]
        fixed = sum(a == i for i, a in enumerate(got))
        assert got != other and fixed < 10 and abs(np.corrcoef(got, range(n))[0, 1]) < 0.1


@pytest.mark.parametrize("n", [0, 1, 37, 10_000])
def test_sample_cap_merges_over_levels(spark, n, monkeypatch):
    """Many tasks, ties between equal keys, nulls and arrays: as a plain sort gives them."""
    monkeypatch.setattr(S, "MERGE", 3)
    df = spark.range(0, 6000, numPartitions=23).selectExpr("cast(id % 700 as int) k", "if(id % 5 = 0, null, id) v", "array(id) a")
    got = S.sample_cap(df, n, ["k"], order_cols=["k", "v"]).collect()
    want = df.withColumn("_h", S.hash_int(S.key_string(["k"], 42), 15)).orderBy("_h", "k", "v").limit(n).drop("_h").collect()
    assert len(got) == min(n, 6000) and sorted((r.k, r.v or -1) for r in got) == sorted((r.k, r.v or -1) for r in want)


@pytest.mark.parametrize("scale", [1, 10 ** 15])
def test_exact_quantiles_equal_percentile(spark, scale):
    from cinerank.operators.quantiles import exact_quantiles
    df = spark.range(0, 3001, numPartitions=9).selectExpr("if(id % 3 = 0, 'a', 'b') g", f"if(id % 100 = 7, null, (id * id * 7919) % 1009 * {scale} - 5) v")
    df = df.unionByName(spark.createDataFrame([("one", 42), ("none", None)], "g string, v long"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, F.col("v"), probs, F.col("g"))
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile(F.col("v").cast("double"), F.array(*map(F.lit, probs))).alias("q")).collect()}
    assert want.pop("none") is None and set(got) == set(want) and got["one"] == [42.0] * 7
    assert all(np.allclose(got[g], want[g], rtol=1e-12) for g in want)
    assert exact_quantiles(df.where("v > 0 and v < 0"), F.col("v"), probs) == {}
    halves = df.selectExpr("g", "v / 3.7 + 1e-9 * v * v as v")
    got = exact_quantiles(halves, F.col("v"), probs)[0]
    assert np.allclose(got, halves.agg(F.percentile("v", F.array(*map(F.lit, probs)))).first()[0], rtol=1e-12)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_with_a_third_of_the_rows_on_one_key(spark, how):
    """Same rows as a plain join; the hot key is found, and no salted task has over twice the median."""
    from cinerank.operators.skew import heavy_hitters, salted_join
    big = spark.range(0, 30_000, numPartitions=8).selectExpr("if(id % 3 = 0, 7, if(id % 100 = 1, null, cast(id % 5000 as int))) k", "id")
    small = spark.range(0, 4000).selectExpr("cast(id as int) k", "concat('u', id) name")
    assert [r["key"] for r in heavy_hitters(big, "k", 0.01).collect()] == [7]
    got, want = salted_join(big, small, "k", how), big.join(small, "k", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert heavy_hitters(big.where("k != 7"), "k", 0.01).count() == 0
    empty = salted_join(big.limit(0), small, "k", how)
    assert empty.count() == 0


def test_salted_join_spreads_the_hot_key(spark):
    from cinerank.operators.skew import salted_join
    big = spark.range(0, 64_000, numPartitions=8).selectExpr("if(id % 3 = 0, 7, cast(id % 5000 as int)) k", "id")
    small = spark.range(0, 5000).selectExpr("cast(id as int) k", "id as u")
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c in before:
            spark.conf.set(c, "false" if "adaptive" in c else "-1")
        sizes = [r["count"] for r in salted_join(big, small, "k").groupBy(F.spark_partition_id()).count().collect()]
        plain = [r["count"] for r in big.join(small, "k").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2] < max(plain)


def test_daily_sketches_merge_and_replace_days(spark):
    import os
    import tempfile

    from cinerank.operators import daily as D
    path = os.path.join(tempfile.mkdtemp(prefix="cinerank-daily-"), "days")
    rows = spark.range(0, 60_000).selectExpr("cast(id % 9000 as int) user_id", "cast(id * 7 % 3000 as int) movie_id", "cast(id * 7919 % 1000 / 10 as float) rating",
                                             "cast(id % 3 * 86400 + id % 1000 as long) ts")
    for day in (0, 1):
        D.add_days(path, rows.where(f"ts div 86400 = {day}"))
    first = sorted((f, os.stat(os.path.join(d, f)).st_mtime_ns) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))
    for _ in range(2):  # a replay replaces its own day only
        D.add_days(path, rows.where("ts div 86400 = 2"))
    now = sorted((f, os.stat(os.path.join(d, f)).st_mtime_ns) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))
    assert set(first) <= set(now) and D.read_days(spark, path).count() == 3
    s = D.sketched_summary(D.read_days(spark, path)).first()
    exact = rows.agg(F.round(F.avg("rating"), 6)).first()[0]
    assert s.n_ratings == 60_000 and abs(s.rating_mean - exact) < 1e-5 and str(s.first_date) == "1970-01-01" and str(s.last_date) == "1970-01-03"
    assert abs(s.n_users / 9000 - 1) < 0.05 and abs(s.n_movies / 3000 - 1) < 0.05
    below = rows.where(F.col("rating") <= s.rating_median).count() / 60_000
    assert abs(below - 0.5) < 0.03


def test_hot_keys_are_found_in_one_pass_over_the_ratings(spark):
    """Salted features read the ratings twice, however many joins: to find the hot keys of all joins, and to join."""
    from cinerank.operators import features as FE
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    ratings = spark.range(4000).selectExpr("cast(if(id % 3 = 0, 1, id % 50) as int) user_id", "cast(if(id % 4 = 0, 2, id % 70) as int) movie_id",
                                           "cast(1 + id % 5 as float) rating", "id % 900 as ts")
    users = spark.range(48).selectExpr("cast(id as int) user_id", "if(id % 2 = 0, 'M', 'F') gender", "18 age", "cast(id % 21 as int) occupation", "'12345' zip")
    movies = spark.range(66).selectExpr("cast(id as int) movie_id", "if(id % 2 = 0, 'Drama|War', 'Comedy') genres")
    want = FE.build_features(ratings, users, movies, keep_keys=True)
    got = FE.build_features(ratings.mapInArrow(counted, ratings.schema), users, movies, keep_keys=True, hot_share=0.02).collect()
    assert seen.value == 2 * 4000
    assert sorted(map(str, got)) == sorted(map(str, want.collect()))


def test_random_split_returns_the_rows_of_both_sides(spark):
    from cinerank.plans import registry
    from cinerank.plans.q_features import fixture_features
    got = registry.queries()["random_split"](spark, SF001)
    rows = FE_report(fixture_features(spark, SF001))
    assert got.select(*rows.columns).exceptAll(rows).count() == 0 and got.count() == rows.count() > 1
    judged = got.drop(*rows.columns).distinct().collect()
    assert [r.asDict() for r in judged] == [{"sides": 1, "n": rows.count(), "in_both": 0, "in_one": rows.count(), "share_within": True}]


def FE_report(features):
    from cinerank.operators.features import features_report
    return features_report(features)


def test_variants_are_the_permuted_columns(spark):
    """Values sent in blocks end in the rows that the bijection names, with repeated keys and nulls, in one shuffle."""
    rows = spark.range(40_000).selectExpr("id % 9000 as user_id", "cast(id % 7 as int) a", "case when id % 50 <> 0 then cast(id % 1013 as int) end as b",
                                          "case when id % 60 <> 0 then cast(id % 5 as double) end as r")
    numbered, n = S.numbered(rows, ["user_id"], 5)
    assert n == 40_000 and -(-n // S.block_rows(n)) == 3
    assert numbered.select("_pos").distinct().count() == n and numbered.agg(F.max("_pos")).first()[0] == n - 1
    h = F.md5(S.key_string(["user_id"], 5))
    order = [r["_pos"] for r in numbered.orderBy(h, *rows.columns).select("_pos").collect()]
    assert order == sorted(order)
    got = S.permuted_variants(numbered, n, ["a", "b"], "r", 5)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    by = got.groupBy("_variant", "a", "b", "r").count()
    want = numbered.selectExpr("0 as _variant", "a", "b", "r")
    for i, c in ((1, "a"), (2, "b")):
        moved = numbered.select(S.bijection("_pos", n, 5, c).alias("_pos"), c)
        want = want.unionByName(numbered.drop(c).join(moved, "_pos").select(F.lit(i).alias("_variant"), "a", "b", "r"))
    want = want.groupBy("_variant", "a", "b", "r").count()
    assert by.exceptAll(want).count() == 0 and want.exceptAll(by).count() == 0
    assert S.permuted_variants(*S.numbered(rows.limit(0), ["user_id"]), ["a"], "r").count() == 0
