"""Scoring a feature DataFrame with a model.

* :func:`score_arrow` - an Arrow UDF over five ints that gives one double. No
  shuffle, no join: the model sees only genres on the movie side and four small
  categoricals on the user side, so each task makes tables of what they add to the
  first layer and looks rows up (``kernel.Scorer``). Networks with many weights score
  the distinct feature keys (profile x genre mask) of a batch once and scatter them
  back. Parameters travel once per executor by broadcast.
* :func:`score_expr` - the same forward pass as Catalyst expressions (CASE
  lookups, sums of products, greatest/least), for small models and for
  cross-engine checks. :func:`forward_sql_stages` emits the same pass as SQL text
  that DuckDB runs as the oracle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from .spec import ModelSpec, bn_fold, param_count

KEY_COLS = ["gender_idx", "age_idx", "occ_idx", "zip_idx", "genre_mask"]
SORT_COST = 1_000  # weights of a network on which a row costs as much as its part in sorting a batch


class Model:
    """A network spec with its parameters (driver-side, size fixed by the spec)."""

    def __init__(self, spec: ModelSpec, params: dict, meta: dict | None = None):
        self.spec = spec
        self.params = params
        self.meta = dict(meta or {})

    def predict_np(self, g, a, o, z, mask, clamp=True):
        gen = K.multihot(mask)
        raw, _ = K.forward(self.params, self.spec, np.asarray(g), np.asarray(a), np.asarray(o),
                           np.asarray(z), gen, train=False)
        return np.clip(raw, self.spec.rating_min, self.spec.rating_max) if clamp else raw


def score_arrow(df: DataFrame, model: Model, out_col: str = "prediction", raw_col: str | None = None) -> DataFrame:
    """``df`` (with gender_idx, age_idx, occ_idx, zip_idx, genre_mask) plus the
    clamped prediction (double) and optionally the raw output. Only the five key
    columns go through Python; the others stay in the JVM."""
    bc = df.sparkSession.sparkContext.broadcast((model.spec, model.params))
    repeats = param_count(model.spec) > SORT_COST

    @F.arrow_udf("double")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        spec, params = bc.value
        scorer = K.Scorer(params, spec)
        for *user, mask in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in (*user, mask.fill_null(0))]
            if not repeats or not len(mask):
                yield pa.array(scorer(*columns))
                continue
            g, a, o, z, mask = (c.astype(np.int64) for c in columns)
            # gender < 2^4, age < 2^4, occ < 2^8, zip < 2^4, mask < 2^18: fits in 38 bits
            keys = (g << 34) | (a << 30) | (o << 22) | (z << 18) | mask
            _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
            yield pa.array(scorer(*(c[first] for c in columns))[inverse.ravel()])

    raw = F.col("_raw")
    clamped = F.least(F.greatest(raw, F.lit(float(model.spec.rating_min))), F.lit(float(model.spec.rating_max)))
    out = df.withColumn("_raw", run(*[F.col(c) for c in KEY_COLS]))
    return out.select(*df.columns, F.when(F.isnan(raw), raw).otherwise(clamped).alias(out_col),  # greatest takes NaN for a number above all
                      *([raw.alias(raw_col)] if raw_col else []))


# ---------------------------------------------------------------------------
# Forward pass as SQL expressions
# ---------------------------------------------------------------------------

def _lit(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _sum(terms) -> str:
    terms = list(terms)
    return "(" + " + ".join(terms) + ")" if terms else _lit(0.0)


def _lookup(col: str, table: np.ndarray) -> str:
    whens = " ".join(f"WHEN {k} THEN {_lit(v)}" for k, v in enumerate(table))
    return f"(CASE {col} {whens} ELSE {_lit(0.0)} END)"


def _user_tower_sql(P, p: str, prefix: str):
    fd = P[f"{p}.gender_emb"].shape[1]
    W, b = P[f"{p}.proj_w"], P[f"{p}.proj_b"]
    cols = ("gender_idx", "age_idx", "occ_idx", "zip_idx")
    embs = ("gender_emb", "age_emb", "occ_emb", "zip_emb")
    out = []
    for j in range(W.shape[0]):
        terms = [_lit(b[j])]
        for k, (c, e) in enumerate(zip(cols, embs)):
            # contribution of field k to output j, per category: E_k @ W[j, block_k]
            table = P[f"{p}.{e}"] @ W[j, k * fd:(k + 1) * fd]
            terms.append(_lookup(c, table))
        out.append((f"{prefix}{j}", _sum(terms)))
    return out


def _movie_tower_sql(P, p: str, prefix: str, n_genres: int = 18):
    W, b = P[f"{p}.proj_w"], P[f"{p}.proj_b"]
    return [(f"{prefix}{j}", _sum([_lit(b[j])] + [f"(g{i} * {_lit(W[j, i])})" for i in range(n_genres)]))
            for j in range(W.shape[0])]


def forward_sql_stages(model: Model):
    """The evaluation forward pass as stages of (alias, SQL expression); each stage
    reads the input columns (gender_idx, age_idx, occ_idx, zip_idx, g0..g17) and the
    aliases of earlier stages. The last stage defines ``raw`` and ``score``."""
    P, spec = model.params, model.spec
    E = spec.embed_dim
    stages = []
    if spec.model_type == "ncf":
        stages.append(_user_tower_sql(P, "user", "u") + _movie_tower_sql(P, "movie", "m"))
        inputs = [f"u{j}" for j in range(E)] + [f"m{j}" for j in range(E)]
    else:
        stages.append(_user_tower_sql(P, "gmf_user", "gu") + _movie_tower_sql(P, "gmf_movie", "gm")
                      + _user_tower_sql(P, "mlp_user", "u") + _movie_tower_sql(P, "mlp_movie", "m"))
        inputs = [f"u{j}" for j in range(E)] + [f"m{j}" for j in range(E)]
    for i, _ in enumerate(spec.hidden_dims):
        W, b = P[f"mlp.{i}.w"], P[f"mlp.{i}.b"]
        scale, shift = bn_fold(P, i)
        stage = []
        for r in range(W.shape[0]):
            lin = _sum([_lit(b[r])] + [f"({c} * {_lit(W[r, k])})" for k, c in enumerate(inputs)])
            stage.append((f"h{i}_{r}", f"GREATEST(({lin} * {_lit(scale[r])}) + {_lit(shift[r])}, {_lit(0.0)})"))
        stages.append(stage)
        inputs = [a for a, _ in stage]
    w, b0 = P["out.w"][0], P["out.b"][0]
    if spec.model_type == "ncf":
        feats = inputs
    else:
        feats = [f"(gu{j} * gm{j})" for j in range(E)] + inputs
    raw = _sum([_lit(b0)] + [f"({c} * {_lit(w[k])})" for k, c in enumerate(feats)])
    stages.append([("raw", raw)])
    stages.append([("score", f"LEAST(GREATEST(raw, {_lit(spec.rating_min)}), {_lit(spec.rating_max)})")])
    return stages


def _arr(values) -> F.Column:
    """A constant double array: one SQL text, folded by Catalyst into one literal."""
    return F.expr("array(" + ", ".join(_number(v) for v in np.ravel(values)) + ")")


def _number(x: float) -> str:
    return f"{float(x)!r}D"


def _mat(W: np.ndarray) -> F.Column:
    return F.expr("array(" + ", ".join("array(" + ", ".join(_number(v) for v in row) + ")" for row in W) + ")")


def _dot(a: F.Column, b: F.Column) -> F.Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def _bind(x: F.Column, fn) -> F.Column:
    """``fn(x)`` with ``x`` evaluated once per row: x is bound to a lambda
    variable, so collapsing projections cannot inline it into an inner lambda
    (where it would be recomputed for every weight row)."""
    return F.element_at(F.transform(F.array(x), fn), 1)


def _matvec(W: np.ndarray, x: F.Column, b: np.ndarray) -> F.Column:
    return _bind(x, lambda xx: F.zip_with(F.transform(_mat(W), lambda row: _dot(row, xx)), _arr(b),
                                          lambda s, c: s + c))


def _user_tower_col(P, p: str) -> F.Column:
    def emb(name, col):
        return F.element_at(_mat(P[f"{p}.{name}"]), F.col(col) + 1)
    x = F.concat(emb("gender_emb", "gender_idx"), emb("age_emb", "age_idx"),
                 emb("occ_emb", "occ_idx"), emb("zip_emb", "zip_idx"))
    return _matvec(P[f"{p}.proj_w"], x, P[f"{p}.proj_b"])


def _movie_tower_col(P, p: str, gen: F.Column) -> F.Column:
    return _matvec(P[f"{p}.proj_w"], gen, P[f"{p}.proj_b"])


def score_expr(df: DataFrame, model: Model, out_col: str = "prediction", raw_col: str | None = None) -> DataFrame:
    """Same as :func:`score_arrow`, computed by Catalyst array expressions only
    (embedding lookups by ``element_at``, layers by ``transform`` / ``zip_with`` /
    ``aggregate`` over constant weight arrays). Expression size grows with the
    number of layers, not with their width."""
    P, spec = model.params, model.spec
    n_gen = spec.feature_dims["num_genres"]
    gen = F.array(*[F.shiftright(F.col("genre_mask"), i).bitwiseAND(1).cast("double") for i in range(n_gen)])
    cols = df.columns
    if spec.model_type == "ncf":
        work = df.select("*", _user_tower_col(P, "user").alias("_u"), _movie_tower_col(P, "movie", gen).alias("_m"))
    else:
        work = df.select("*", _user_tower_col(P, "mlp_user").alias("_u"),
                         _movie_tower_col(P, "mlp_movie", gen).alias("_m"),
                         F.zip_with(_user_tower_col(P, "gmf_user"), _movie_tower_col(P, "gmf_movie", gen),
                                    lambda a, b: a * b).alias("_gmf"))
    work = work.withColumn("_h", F.concat("_u", "_m"))
    for i, _ in enumerate(spec.hidden_dims):
        scale, shift = bn_fold(P, i)
        z = _matvec(P[f"mlp.{i}.w"], F.col("_h"), P[f"mlp.{i}.b"])
        bn = _bind(z, lambda zz: F.zip_with(F.zip_with(zz, _arr(scale), lambda a, s: a * s), _arr(shift),
                                            lambda a, c: a + c))
        work = work.withColumn("_h", _bind(bn, lambda bb: F.transform(bb, lambda v: F.greatest(v, F.lit(0.0)))))
    feats = F.col("_h") if spec.model_type == "ncf" else F.concat("_gmf", "_h")
    raw = _bind(feats, lambda ff: _dot(_arr(P["out.w"][0]), ff)) + F.lit(float(P["out.b"][0]))
    work = work.withColumn("_raw", raw)
    score = F.least(F.greatest(F.col("_raw"), F.lit(spec.rating_min)), F.lit(spec.rating_max))
    return work.select(*cols, score.alias(out_col), *([F.col("_raw").alias(raw_col)] if raw_col else []))


def score_sql(model: Model, input_sql: str) -> str:
    """SQL text scoring the rows of ``input_sql`` (which must expose gender_idx,
    age_idx, occ_idx, zip_idx and g0..g17); adds columns ``raw`` and ``score``."""
    sql = input_sql
    for k, stage in enumerate(forward_sql_stages(model)):
        exprs = ", ".join(f"{e} AS {a}" for a, e in stage)
        sql = f"SELECT *, {exprs} FROM ({sql}) s{k}"
    return sql


def _tower_job(df: DataFrame, model: Model, kind: str, prefix: str, out_col: str) -> DataFrame:
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(model.params)
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def run(batches):
        P = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            if kind == "user":
                vec = K._user_fwd(P, prefix, pdf["gender_idx"].to_numpy(np.int64),
                                  pdf["age_idx"].to_numpy(np.int64), pdf["occ_idx"].to_numpy(np.int64),
                                  pdf["zip_idx"].to_numpy(np.int64))
            else:
                vec = K._movie_fwd(P, prefix, K.multihot(pdf["genre_mask"].to_numpy()))
            pdf = pdf.copy()
            pdf[out_col] = list(vec)
            yield pdf

    return df.mapInPandas(run, out_schema)


def user_vectors(profiles: DataFrame, model: Model, tower: str | None = None) -> DataFrame:
    """User-tower output for each distinct (gender_idx, age_idx, occ_idx, zip_idx);
    at most 2 x 7 x 21 x 11 rows whatever the input size (partial aggregate first)."""
    tower = tower or ("user" if model.spec.model_type == "ncf" else "mlp_user")
    keys = profiles.select("gender_idx", "age_idx", "occ_idx", "zip_idx").distinct()
    return _tower_job(keys, model, "user", tower, "user_vec")


def movie_vectors(genre_sets: DataFrame, model: Model, tower: str | None = None) -> DataFrame:
    """Movie-tower output for each distinct genre mask."""
    tower = tower or ("movie" if model.spec.model_type == "ncf" else "mlp_movie")
    keys = genre_sets.select("genre_mask").distinct()
    return _tower_job(keys, model, "movie", tower, "movie_vec")
