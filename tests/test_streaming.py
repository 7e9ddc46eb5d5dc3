"""Streaming recommendation: same rows as the bulk job, and replays do not duplicate."""
import os
import tempfile

from pyspark.sql import functions as F

from cinerank.operators import recommend as R
from cinerank.plans.q_model import fixed_model
from cinerank.sources.fixtures import load_fixture, load_requests
from cinerank.streaming.recommend_stream import run_recommend_stream
from conftest import SF001


def test_stream_matches_bulk_and_restart_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="cinerank-stream-")
    req_dir, out_dir = (os.path.join(base, n) for n in ("req", "out"))
    reqs = load_requests(spark, SF001)
    os.makedirs(req_dir)
    movies = load_fixture(spark, SF001).movies
    model = fixed_model("ncf")
    flat = lambda df: df.select("request_id", "status", "reject_reason", "zip_code", "top_n", F.to_json("items"))
    assert run_recommend_stream(spark, req_dir, movies, model, out_dir).count() == 0  # no file has come yet
    reqs.repartition(3).write.mode("append").json(req_dir)
    first = flat(run_recommend_stream(spark, req_dir, movies, model, out_dir))
    bulk = flat(R.recommend_responses(reqs, movies, model))
    assert first.count() == bulk.count() == reqs.count() > 0
    assert first.exceptAll(bulk).count() == 0
    # restart on the same output: no new files, so nothing is written twice
    again = flat(run_recommend_stream(spark, req_dir, movies, model, out_dir))
    assert again.count() == first.count() and again.exceptAll(bulk).count() == 0


def test_answers_are_kept_until_the_model_changes(spark):
    """Repeated profiles are ranked once; another model drops what was kept and answers by itself."""
    from cinerank.model.score import Model
    from cinerank.model.spec import fixed_params
    base = tempfile.mkdtemp(prefix="cinerank-stream-")
    req_dir, out_dir = (os.path.join(base, n) for n in ("req", "out"))
    os.makedirs(req_dir)
    reqs, movies, model = load_requests(spark, SF001).limit(60).cache(), load_fixture(spark, SF001).movies, fixed_model("ncf")
    other = Model(model.spec, fixed_params(model.spec, out_bias=2.25))
    flat = lambda df: df.select("request_id", "status", "reject_reason", "zip_code", "top_n", F.to_json("items"))
    kept = []
    for m in (model, model, other):
        reqs.coalesce(1).write.mode("append").json(req_dir)
        out = run_recommend_stream(spark, req_dir, movies, m, out_dir)
        last = out.where(F.col("batch_id") == out.agg(F.max("batch_id")).first()[0])
        bulk = flat(R.recommend_responses(reqs, movies, m))
        assert flat(last).exceptAll(bulk).count() == 0 and bulk.exceptAll(flat(last)).count() == 0
        versions = os.listdir(os.path.join(out_dir, "_answers"))
        assert len(versions) == 1
        answers = spark.read.parquet(os.path.join(out_dir, "_answers", versions[0]))
        kept.append((versions[0], sorted((r["batch_id"], r["count"]) for r in answers.groupBy("batch_id").count().collect())))
    asked = R.asked_profiles(reqs).count()
    assert kept[0] == kept[1] and kept[0][1][0][1] == asked and len(kept[0][1]) == 1  # the second batch ranked nothing
    assert kept[2][0] != kept[0][0] and kept[2][1][0][1] == asked
