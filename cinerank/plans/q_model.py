"""Registered queries for scoring, metrics, training and importance."""

from __future__ import annotations

import hashlib
import math
import os
from dataclasses import asdict

from pyspark.sql import functions as F

from ..functions import encoders as E
from ..model.score import KEY_COLS, Model, forward_sql_stages, score_arrow, score_expr, score_sql
from ..model.spec import ModelSpec, fixed_params
from ..model.train import FitConfig, fit, learning_curve, prepare_shards
from ..operators import evaluate as EV
from ..operators import split as S
from ..session import ensure_checkpoint_dir, stored_rows
from ..sources.model_store import load_model, save_model
from .q_features import _FEATURES_CTE, _KEY, _REPORT_COLS, _SPLIT_CTE, fixture_features, recursive
from .registry import (age_idx_sql, gender_idx_sql, genre_flags_sql, genre_mask_sql, genre_parts_sql,
                       register, sql_with, zip_idx_sql)

# Fixed-parameter networks for exact cross-engine checks: small enough to write
# as SQL, values exact in doubles (see spec.fixed_params).
FIXED_EMBED, FIXED_HIDDEN = 4, [4]


def fixed_model(model_type: str) -> Model:
    spec = ModelSpec(model_type, embed_dim=FIXED_EMBED, hidden_dims=FIXED_HIDDEN, dropout=0.0)
    return Model(spec, fixed_params(spec))


_FLAGS = ", ".join(f"cast(substr(genres, {i + 1}, 1) as double) as g{i}" for i in range(18))


def _fixed_score_oracle(model_type: str) -> str:
    inner = f"select {_REPORT_COLS}, {_FLAGS} from feat"
    return sql_with(["ratings", "users", "movies"], [_FEATURES_CTE],
                    body=f"select {_REPORT_COLS}, raw, score from ({score_sql(fixed_model(model_type), inner)}) q")


def _fixed_score_query(model_type: str):
    def q(spark, sf_dir):
        feats = fixture_features(spark, sf_dir, keep_keys=False).drop("genres")  # the mask says the same; rows wait for Python's answer
        scored = score_arrow(feats, fixed_model(model_type), "score", "raw")
        return scored.select("gender_idx", "age_idx", "occ_idx", "zip_idx",
                             E.mask_string("genre_mask").alias("genres"),
                             F.col("rating").cast("double").alias("rating"), "raw", "score")
    return q


register("score_ncf_fixed", _fixed_score_oracle("ncf"))(_fixed_score_query("ncf"))
register("score_neumf_fixed", _fixed_score_oracle("neumf"))(_fixed_score_query("neumf"))


@register("regression_metrics", sql_with(["ratings", "users", "movies"], [
    _FEATURES_CTE, _SPLIT_CTE,
    ("means", "select age_idx, avg(rating) as prediction from labelled where split = 'train' group by age_idx"),
    ("pred", "select t.rating, m.prediction from labelled t join means m on t.age_idx = m.age_idx "
             "where t.split = 'test'"),
], body="""
select round(avg((prediction - rating) * (prediction - rating)), 6) as mse,
  round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) as rmse,
  round(avg(abs(prediction - rating)), 6) as mae, cast(count(*) as bigint) as n from pred"""))
def q_regression_metrics(spark, sf_dir):
    """Metrics of a group-mean predictor (train mean rating per age group) on the test split."""
    train, test = S.hash_split(fixture_features(spark, sf_dir))
    means = train.groupBy("age_idx").agg(F.avg(F.col("rating").cast("double")).alias("prediction"))
    # means has at most 7 rows (one per age group): proven-small broadcast side
    pred = test.join(F.broadcast(means), "age_idx")
    return EV.rounded(EV.regression_metrics(pred))


# ---------------------------------------------------------------------------
# Trained models (no SQL oracle: checked by row count here, by value in pytest)
# ---------------------------------------------------------------------------

#: Test RMSE that a trained network must reach on the fixture (FIXTURES.md 3).
RMSE_GATE = 0.62


def trained_model(spark, sf_dir, model_type: str, cfg: FitConfig | None = None):
    """(model, test rows). The fitted model is stored in the shared folder under its training rows, network and
    configuration; a later query of the same application loads it instead of fitting again."""
    cfg = cfg or FitConfig()
    # Joined and split once, then read from storage: by the hash below, by the training and by all that reads the test rows.
    feats = S.with_split(fixture_features(spark, sf_dir).select(*S.RATING_KEY, *KEY_COLS, "rating"))
    feats = stored_rows(feats, "features")
    train, test = (feats.where(F.col("split") == side).drop("split") for side in ("train", "test"))
    rows = F.xxhash64(*train.columns).cast("decimal(38,0)")
    data = tuple(train.agg(F.count(F.lit(1)), F.sum(rows)).first())  # other rows are other data, whatever their path
    key = hashlib.md5(repr((spark.sparkContext.applicationId, data, model_type, asdict(cfg))).encode()).hexdigest()
    path = os.path.join(ensure_checkpoint_dir(spark), "models", key)
    try:
        return load_model(spark, path), test
    except FileNotFoundError:  # not stored yet
        shards = prepare_shards(train, cfg.rows_per_shard, cfg.fan_in, n=data[0]) if cfg.sync == "epoch" else None
        model = fit(train, ModelSpec(model_type), cfg, shards=shards)
        save_model(spark, model, path)
        return model, test


_SIDE = """select {columns}, cast(count(*) as bigint) as n, round(avg(rating), 6) as label_mean,
  round(var_pop(rating), 6) as label_var, true as within_gate from labelled where split = 'test'"""


def _side_oracle(columns: str) -> str:
    return sql_with(["ratings", "users", "movies"], [_FEATURES_CTE, _SPLIT_CTE], body=_SIDE.format(columns=columns))


def _with_side(test, metrics, *columns):
    """What SQL knows of the test rows, and whether the metrics (one row: rmse, n) count them and reach the gate."""
    m = metrics.first()
    side = test.agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.round(F.avg(F.col("rating").cast("double")), 6).alias("label_mean"),
                    F.round(F.var_pop(F.col("rating").cast("double")), 6).alias("label_var"))
    return side.select(*columns, "*", ((F.col("n") == m["n"]) & F.lit(m["rmse"] <= RMSE_GATE)).alias("within_gate"))


def _fit_query(model_type: str):
    def q(spark, sf_dir):
        model, test = trained_model(spark, sf_dir, model_type)
        return _with_side(test, EV.evaluate(test, model), F.lit(model_type).alias("model_type"),
                          F.lit(len(model.meta["history"])).cast("bigint").alias("epochs"))
    return q


register("fit_ncf", _side_oracle("'ncf' as model_type, cast(10 as bigint) as epochs"))(_fit_query("ncf"))
register("fit_neumf", _side_oracle("'neumf' as model_type, cast(10 as bigint) as epochs"))(_fit_query("neumf"))


#: A linear network (no hidden layer), small enough for its gradient to be SQL; one step over all training rows.
STEP_SPEC = ModelSpec("ncf", embed_dim=FIXED_EMBED, hidden_dims=[], dropout=0.0)
STEP_CONFIG = FitConfig(num_epochs=1, sync="step", replicas=1, sync_workers=1, batch_size=1 << 40, max_grad_norm=math.inf, out_bias_from_mean=False)


def _step_oracle() -> str:
    """Loss and Adam's first moments after one step: (1 - beta1) (gradient + weight decay x parameter)."""
    P = fixed_params(STEP_SPEC)
    w, E_ = P["out.w"][0], FIXED_EMBED
    sums = {"d": "avg(2 * err)"}
    sums |= {f"d{x}": f"avg(2 * err * {x})" for x in [f"u{j}" for j in range(E_)] + [f"m{j}" for j in range(E_)] + [f"g{i}" for i in range(18)]}
    sums |= {f"ds{k}": f"avg(case when gender_idx = {k} then 2 * err else 0.0 end)" for k in (0, 1)}
    terms = [("out.b", 0, "d", P["out.b"][0])]
    terms += [("out.w", j, f"d{x}", w[j]) for j, x in enumerate([f"u{j}" for j in range(E_)] + [f"m{j}" for j in range(E_)])]
    terms += [("user.proj_b", j, f"d * {float(w[j])!r}", P["user.proj_b"][j]) for j in range(E_)]
    terms += [("movie.proj_w", j * 18 + i, f"dg{i} * {float(w[E_ + j])!r}", P["movie.proj_w"][j, i]) for j in range(E_) for i in range(18)]
    fd = STEP_SPEC.field_dim
    back = w[:E_] @ P["user.proj_w"][:, :fd]
    terms += [("user.gender_emb", k * fd + c, f"ds{k} * {float(back[c])!r}", P["user.gender_emb"][k, c]) for k in (0, 1) for c in range(fd)]
    values = " union all ".join(f"select '{n}' as name, cast({i} as bigint) as idx, round(0.1 * ({e} + 0.00001 * {float(p)!r}), 8) as moment from a"
                                for n, i, e, p in terms)
    return sql_with(["ratings", "users", "movies"], [
        _FEATURES_CTE, _SPLIT_CTE, ("train", "select * from labelled where split = 'train'"),
        ("scored", score_sql(Model(STEP_SPEC, P), f"select *, {_FLAGS} from train")),
        ("e", "select *, raw - rating as err from scored"),
        ("a", "select avg(err * err) as loss, " + ", ".join(f"{v} as {k}" for k, v in sums.items()) + " from e")],
        body=f"select 'loss' as name, cast(0 as bigint) as idx, round(loss, 8) as moment from a union all {values}")


@register("fit_step_fixed", _step_oracle())
def q_fit_step_fixed(spark, sf_dir):
    """Gradients of one synchronous training step from fixed parameters, as Adam's first moments."""
    train, _ = S.hash_split(fixture_features(spark, sf_dir))
    model = fit(train, STEP_SPEC, STEP_CONFIG, init=Model(STEP_SPEC, fixed_params(STEP_SPEC), {}))
    first = model.meta["optimizer"]["m"]
    rows = [("loss", 0, round(model.meta["history"][0][1], 8))]
    for name in ("out.b", "out.w", "user.proj_b", "movie.proj_w", "user.gender_emb"):
        rows += [(name, i, float(v)) for i, v in enumerate(first[name].ravel())]
    return spark.createDataFrame(rows, "name string, idx long, moment double").withColumn("moment", F.round("moment", 8))


@register("learning_curve")
def q_learning_curve(spark, sf_dir):
    model, test = trained_model(spark, sf_dir, "ncf")
    rmse = EV.evaluate(test, model).first()["rmse"]
    return learning_curve(spark, model, float(rmse))


@register("evaluation_report")
def q_evaluation_report(spark, sf_dir):
    model, test = trained_model(spark, sf_dir, "ncf")
    return EV.evaluation_report(test, model)


@register("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    model, test = trained_model(spark, sf_dir, "ncf")
    return EV.permutation_importance(test, model)


def _fixed_test(rows: str, name: str = "scored", model_type: str = "ncf") -> tuple[str, str]:
    """CTE of fixed-parameter scores over ``rows`` (feature columns and anything else)."""
    return name, score_sql(fixed_model(model_type), f"select *, {_FLAGS} from {rows}")


_METRICS = """sum((score - rating) * (score - rating)) / count(*) as mse, sum(abs(score - rating)) / count(*) as mae, count(*) as n"""


@register("evaluation_report_fixed", sql_with(["ratings", "users", "movies"], [
    _FEATURES_CTE, _SPLIT_CTE, ("test", "select * from labelled where split = 'test'"), _fixed_test("test"),
    ("m", f"select {_METRICS} from scored")], body="""
select s.scorer, round(mse, 6) as mse, round(sqrt(mse), 6) as rmse, round(mae, 6) as mae, cast(n as bigint) as n, 0.0::double as max_diff
from m, (values ('arrow'), ('expression')) s(scorer)"""))
def q_evaluation_report_fixed(spark, sf_dir):
    _, test = S.hash_split(fixture_features(spark, sf_dir))
    report = EV.rounded(EV.evaluation_report(test, fixed_model("ncf")))
    return report.withColumn("max_diff", F.round("max_diff", 9))


def _importance_oracle() -> str:
    order = "user_id, movie_id, ts, gender_idx, age_idx, occ_idx, zip_idx, genre_mask, rating"
    rows = ("r", f"select *, row_number() over (order by md5({_KEY}), {order}) - 1 as pos from "
                 f"(select *, {genre_mask_sql_of_flags()} as genre_mask from labelled where split = 'test') q")
    ctes, names = [_FEATURES_CTE, _SPLIT_CTE, rows, _fixed_test("r", "s_baseline")], [("baseline", "s_baseline")]
    for _, label, col in EV.FEATURE_GROUPS:
        value = "genres" if col == "genre_mask" else col
        ctes += S.bijection_sql(f"to_{col}", "r", 42, col)
        ctes.append((f"p_{col}", f"select r.* replace (v.{value} as {value}) from r join to_{col} t on t.x = r.pos join r v on v.pos = t.pos"))
        ctes.append(_fixed_test(f"p_{col}", f"s_{col}"))
        names.append((label, f"s_{col}"))
    ctes.append(("m", " union all ".join(f"select '{label}' as feature, sqrt(avg((score - rating) * (score - rating))) as rmse from {t}" for label, t in names)))
    return recursive(sql_with(["ratings", "users", "movies"], ctes, body="""
select m.feature, round(m.rmse, 6) as shuffled_rmse, round(b.rmse, 6) as baseline_rmse, round(m.rmse - b.rmse, 6) as importance
from m, (select rmse from m where feature = 'baseline') b where m.feature <> 'baseline'"""))


def genre_mask_sql_of_flags() -> str:
    return "(" + " + ".join(f"{1 << i} * cast(substr(genres, {i + 1}, 1) as integer)" for i in range(18)) + ")"


@register("permutation_importance_fixed", _importance_oracle())
def q_permutation_importance_fixed(spark, sf_dir):
    _, test = S.hash_split(fixture_features(spark, sf_dir))
    out = EV.permutation_importance(test, fixed_model("ncf"))
    return out.select("feature", *[F.round(c, 6).alias(c) for c in ("shuffled_rmse", "baseline_rmse", "importance")])


def _score_expr_query(model_type: str):
    def q(spark, sf_dir):
        feats = fixture_features(spark, sf_dir, keep_keys=False)
        keys = feats.select(*KEY_COLS).distinct()
        scored = score_expr(keys, fixed_model(model_type), "score", "raw")
        return scored.select(*KEY_COLS, F.round("raw", 9).alias("raw"), F.round("score", 9).alias("score"))
    return q


def _score_expr_oracle(model_type: str) -> str:
    inner = (f"select distinct gender_idx, age_idx, occ_idx, zip_idx, {genre_mask_sql_of_flags()} as genre_mask, {_FLAGS} from feat")
    return sql_with(["ratings", "users", "movies"], [_FEATURES_CTE], body=f"""
select gender_idx, age_idx, occ_idx, zip_idx, genre_mask, round(raw, 9) as raw, round(score, 9) as score
from ({score_sql(fixed_model(model_type), inner)}) q""")


for _type in ("ncf", "neumf"):
    register(f"score_expr_{_type}_fixed", _score_expr_oracle(_type))(_score_expr_query(_type))


@register("training_run", _side_oracle("'ncf' as model_type"))
def q_training_run(spark, sf_dir):
    """Load, encode, split, fit (ncf, defaults), store model and results JSON in
    the shared scratch folder; returns what is known of the test rows and whether the gate is reached."""
    from ..session import scratch_path
    from ..sources.fixtures import load_fixture
    from .training_run import run_training
    metrics = run_training(spark, *load_fixture(spark, sf_dir), out_dir=scratch_path(spark, "training-run"))
    _, test = S.hash_split(fixture_features(spark, sf_dir))
    return _with_side(test, metrics, F.lit("ncf").alias("model_type"))


def _tower_oracle(kind: str) -> str:
    stage0 = dict(forward_sql_stages(fixed_model("ncf"))[0])
    if kind == "user":
        cols = ", ".join(f"{stage0[f'u{j}']} as u{j}" for j in range(FIXED_EMBED))
        return sql_with(["users"], body=f"""select gender_idx, age_idx, occ_idx, zip_idx, {cols} from (
  select distinct {gender_idx_sql('gender')} as gender_idx, {age_idx_sql('age')} as age_idx,
    occupation as occ_idx, {zip_idx_sql('zip')} as zip_idx from users where occupation between 0 and 20) p""")
    flags = ", ".join(f"cast({f} as double) as g{i}" for i, f in enumerate(genre_flags_sql(genre_parts_sql("genres"))))
    cols = ", ".join(f"{stage0[f'm{j}']} as m{j}" for j in range(FIXED_EMBED))
    mask = genre_mask_sql(genre_parts_sql("genres"))
    return sql_with(["movies"], body=f"""select genre_mask, {cols} from (
  select distinct {mask} as genre_mask, {flags} from movies) s""")


@register("user_vectors_fixed", _tower_oracle("user"))
def q_user_vectors_fixed(spark, sf_dir):
    from ..model.score import user_vectors
    from ..operators.features import encode_users
    from ..sources.fixtures import load_fixture
    users = encode_users(load_fixture(spark, sf_dir).users).filter(F.col("occ_idx").between(0, 20))
    v = user_vectors(users, fixed_model("ncf"))
    return v.select("gender_idx", "age_idx", "occ_idx", "zip_idx",
                    *[F.col("user_vec")[j].alias(f"u{j}") for j in range(FIXED_EMBED)])


@register("movie_vectors_fixed", _tower_oracle("movie"))
def q_movie_vectors_fixed(spark, sf_dir):
    from ..model.score import movie_vectors
    from ..operators.features import encode_movies
    from ..sources.fixtures import load_fixture
    v = movie_vectors(encode_movies(load_fixture(spark, sf_dir).movies), fixed_model("ncf"))
    return v.select("genre_mask", *[F.col("movie_vec")[j].alias(f"m{j}") for j in range(FIXED_EMBED)])
