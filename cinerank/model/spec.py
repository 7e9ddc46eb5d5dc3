"""Network choice, parameter layout, start values and the parameter table.

Two networks predict a rating from content features only (no ids):

* ``ncf``   - user tower and movie tower, concatenated, through an MLP
              ([Linear, BatchNorm, ReLU, Dropout] per hidden size), linear to 1.
* ``neumf`` - a GMF stream (element product of its own two towers) next to the
              MLP stream of its own two towers, concatenated, linear to 1.

User tower: four embeddings of size max(8, embed_dim // 2), concatenated and
projected to embed_dim. Movie tower: linear 18 -> embed_dim. Output clamped to
[rating_min, rating_max] when scoring.

Parameters live in a flat name -> numpy array dict on the driver (its size is
fixed by the network, not by the data) and as a Spark table
``(name, shape, values, trainable)`` for storage.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

from .. import schema

MODEL_TYPES = ("ncf", "neumf")
BN_EPS = 1e-5
BN_MOMENTUM = 0.1


@dataclass
class ModelSpec:
    model_type: str = "ncf"
    embed_dim: int = 32
    hidden_dims: list = field(default_factory=lambda: [128, 64])
    dropout: float = 0.3
    rating_min: float = 1.0
    rating_max: float = 5.0
    feature_dims: dict = field(default_factory=schema.feature_dims)

    def __post_init__(self):
        self.model_type = str(self.model_type).lower()
        if self.model_type not in MODEL_TYPES:
            raise ValueError(f"no network is named {self.model_type!r}; there are {', '.join(MODEL_TYPES)}")
        self.hidden_dims = [int(h) for h in self.hidden_dims]

    @property
    def field_dim(self) -> int:
        return max(8, self.embed_dim // 2)

    def to_dict(self) -> dict:
        return {"model_type": self.model_type, "embed_dim": self.embed_dim,
                "hidden_dims": list(self.hidden_dims), "dropout": self.dropout,
                "rating_min": self.rating_min, "rating_max": self.rating_max,
                "feature_dims": dict(self.feature_dims)}

    @classmethod
    def from_dict(cls, d: dict) -> "ModelSpec":
        if "feature_dims" not in d:
            raise ValueError("model metadata lacks feature_dims: not a content-feature model")
        return cls(**{k: d[k] for k in ("model_type", "embed_dim", "hidden_dims", "dropout",
                                        "rating_min", "rating_max", "feature_dims") if k in d})

    # -- layout ---------------------------------------------------------------
    def user_tower(self, p: str):
        fd, E = self.field_dim, self.embed_dim
        d = self.feature_dims
        return [(f"{p}.gender_emb", (d["num_gender"], fd), "emb"),
                (f"{p}.age_emb", (d["num_age"], fd), "emb"),
                (f"{p}.occ_emb", (d["num_occupation"], fd), "emb"),
                (f"{p}.zip_emb", (d["num_zip"], fd), "emb"),
                (f"{p}.proj_w", (E, 4 * fd), "w"),
                (f"{p}.proj_b", (E,), "b")]

    def movie_tower(self, p: str):
        return [(f"{p}.proj_w", (self.embed_dim, self.feature_dims["num_genres"]), "w"),
                (f"{p}.proj_b", (self.embed_dim,), "b")]

    def mlp(self):
        out, n_in = [], 2 * self.embed_dim
        for i, h in enumerate(self.hidden_dims):
            out += [(f"mlp.{i}.w", (h, n_in), "w"), (f"mlp.{i}.b", (h,), "b"),
                    (f"mlp.{i}.gamma", (h,), "gamma"), (f"mlp.{i}.beta", (h,), "beta"),
                    (f"mlp.{i}.run_mean", (h,), "run_mean"), (f"mlp.{i}.run_var", (h,), "run_var")]
            n_in = h
        return out, n_in

    def layout(self):
        """[(name, shape, kind)] in a fixed order. Kinds run_mean / run_var are
        BatchNorm buffers, not trained."""
        mlp, last = self.mlp()
        if self.model_type == "ncf":
            return (self.user_tower("user") + self.movie_tower("movie") + mlp
                    + [("out.w", (1, last), "w"), ("out.b", (1,), "b")])
        return (self.user_tower("gmf_user") + self.movie_tower("gmf_movie")
                + self.user_tower("mlp_user") + self.movie_tower("mlp_movie") + mlp
                + [("out.w", (1, self.embed_dim + last), "w"), ("out.b", (1,), "b")])

    def trainable_names(self):
        return [n for n, _, k in self.layout() if k not in ("run_mean", "run_var")]

    def buffer_names(self):
        return [n for n, _, k in self.layout() if k in ("run_mean", "run_var")]


def param_count(spec: ModelSpec) -> int:
    return int(sum(int(np.prod(s)) for n, s, k in spec.layout() if k not in ("run_mean", "run_var")))


def init_params(spec: ModelSpec, seed: int = 42, out_bias: float | None = None) -> dict:
    """normal(0, 0.05) embeddings, Xavier-uniform weights, zero biases, BatchNorm
    at identity. ``out_bias`` sets the output bias (e.g. the mean rating)."""
    rng = np.random.default_rng(seed)
    params = {}
    for name, shape, kind in spec.layout():
        if kind == "emb":
            v = rng.normal(0.0, 0.05, size=shape)
        elif kind == "w":
            fan_out, fan_in = shape
            a = math.sqrt(6.0 / (fan_in + fan_out))
            v = rng.uniform(-a, a, size=shape)
        elif kind in ("gamma", "run_var"):
            v = np.ones(shape)
        else:
            v = np.zeros(shape)
        params[name] = v.astype(np.float64)
    if out_bias is not None:
        params["out.b"][:] = out_bias
    return params


def fixed_params(spec: ModelSpec, out_bias: float = 3.0) -> dict:
    """Deterministic parameters for cross-engine checks.

    Value i of weight tensor s (embeddings and linear layers, in layout order)
    is ((i*31 + s*17) % 17 - 8) / 64. BatchNorm is the identity in evaluation
    (gamma = sqrt(1 + eps), running var 1, so the folded scale is exactly 1),
    and the output bias is ``out_bias``. All values are small dyadic rationals,
    so sums are exact in doubles and every engine gets the same bits.
    """
    params, s = {}, 0
    for name, shape, kind in spec.layout():
        size = int(np.prod(shape))
        if kind in ("emb", "w", "b"):
            i = np.arange(size)
            v = (((i * 31 + s * 17) % 17) - 8) / 64.0
            s += 1
        elif kind == "gamma":
            v = np.full(size, math.sqrt(1.0 + BN_EPS))
        elif kind == "run_var":
            v = np.ones(size)
        else:
            v = np.zeros(size)
        params[name] = np.asarray(v, dtype=np.float64).reshape(shape)
    params["out.b"][:] = out_bias
    return params


def flatten(params: dict, names) -> np.ndarray:
    return np.concatenate([np.asarray(params[n], dtype=np.float64).ravel() for n in names])


def unflatten(vec: np.ndarray, spec: ModelSpec, names) -> dict:
    shapes = {n: s for n, s, _ in spec.layout()}
    out, pos = {}, 0
    for n in names:
        size = int(np.prod(shapes[n]))
        out[n] = np.asarray(vec[pos:pos + size], dtype=np.float64).reshape(shapes[n])
        pos += size
    return out


def bn_fold(params: dict, layer: int):
    """Evaluation-mode BatchNorm of hidden layer ``layer`` as (scale, shift)."""
    g, b = params[f"mlp.{layer}.gamma"], params[f"mlp.{layer}.beta"]
    rm, rv = params[f"mlp.{layer}.run_mean"], params[f"mlp.{layer}.run_var"]
    scale = g / np.sqrt(rv + BN_EPS)
    return scale, b - rm * scale


def param_table(spark, spec: ModelSpec, params: dict):
    """Parameters as a Spark table (name, shape, values, trainable)."""
    rows = [(n, [int(x) for x in s], [float(x) for x in np.ravel(params[n])],
             k not in ("run_mean", "run_var")) for n, s, k in spec.layout()]
    return spark.createDataFrame(rows, "name string, shape array<int>, values array<double>, trainable boolean")


def params_from_rows(rows) -> dict:
    return {r["name"]: np.asarray(r["values"], dtype=np.float64).reshape(tuple(r["shape"])) for r in rows}
