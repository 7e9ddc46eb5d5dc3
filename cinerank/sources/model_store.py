"""Model storage: versions of a parameter table (parquet) plus one metadata JSON record, and a log of commits.

A save writes a version folder of its own and then one small commit file that names it. Readers take the newest whole commit, so a
save that dies half way, or a second one at the same time, leaves a whole model readable: parameters and metadata never mix.
"""

from __future__ import annotations

import json
import os
import uuid

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..model.score import Model
from ..model.spec import ModelSpec, param_table, params_from_rows


def _jsonable(x):
    if isinstance(x, dict):
        return {k: _jsonable(v) for k, v in x.items()}
    if isinstance(x, (list, tuple)):
        return [_jsonable(v) for v in x]
    if isinstance(x, np.generic):
        return x.item()
    return x


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of each whole commit, oldest first. A commit file that was not written to its end doesn't count."""
    try:
        rows = spark.read.text(os.path.join(path, "commits")).select(F.input_file_name().alias("f"), "value").collect()
    except AnalysisException:
        return []
    found = []
    for r in rows:
        try:
            found.append((int(os.path.basename(r["f"])), json.loads(r["value"])["version"]))
        except (ValueError, KeyError, TypeError):
            continue
    return sorted(found)


def commit(spark: SparkSession, path: str, version: str) -> int:
    """Makes ``version`` the newest one. The file is created, never replaced: of two savers with one number, the second takes the next."""
    fs, at = _file_system(spark, os.path.join(path, "commits"))
    taken = [int(x.getPath().getName()) for x in fs.listStatus(at) if x.getPath().getName().isdigit()] if fs.exists(at) else []
    number = max(taken, default=0) + 1
    while True:
        _, file = _file_system(spark, os.path.join(path, "commits", f"{number:010d}"))
        if not fs.exists(file):
            break
        number += 1
    out = fs.create(file, False)
    out.write(bytearray(json.dumps({"version": version}).encode()))
    out.close()
    return number


def prune_models(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes the committed versions before the last ``keep`` (never those still being written); how many."""
    log = commits(spark, path)
    kept = {v for _, v in log[-keep:]}
    old = [(n, v) for n, v in log[:-keep] if v not in kept]
    for n, v in old:
        for part in (os.path.join("commits", f"{n:010d}"), os.path.join("versions", v)):
            fs, at = _file_system(spark, os.path.join(path, part))
            fs.delete(at, True)
    return len(old)


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    """Parameters (and Adam moments, when present) as rows of
    ``(name, shape, values, trainable)``; metadata as one JSON record. Readable from its commit on."""
    version = uuid.uuid4().hex
    to = os.path.join(path, "versions", version)
    table = param_table(spark, model.spec, model.params)
    opt = model.meta.get("optimizer")
    if opt:
        extra = []
        for kind in ("m", "v"):
            for n, v in opt[kind].items():
                extra.append((f"opt.{kind}.{n}", [int(s) for s in np.shape(v)],
                              [float(x) for x in np.ravel(v)], False))
        table = table.unionByName(spark.createDataFrame(
            extra, "name string, shape array<int>, values array<double>, trainable boolean"))
    table.coalesce(1).write.parquet(os.path.join(to, "params"))
    meta = {k: v for k, v in model.meta.items() if k != "optimizer"}
    meta.update(model.spec.to_dict())
    if opt:
        meta["optimizer_step"] = opt.get("step")
    record = json.dumps(_jsonable(meta), sort_keys=True)
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.text(os.path.join(to, "meta"))
    commit(spark, path, version)


def load_model(spark: SparkSession, path: str) -> Model:
    """The newest committed model; FileNotFoundError if there is none. Rejects metadata without ``feature_dims``."""
    log = commits(spark, path)
    if not log:
        raise FileNotFoundError(f"no model is committed in {path}")
    path = os.path.join(path, "versions", log[-1][1])
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    spec = ModelSpec.from_dict(meta)
    rows = spark.read.parquet(os.path.join(path, "params")).collect()  # size of the network
    params = params_from_rows([r for r in rows if not r["name"].startswith("opt.")])
    if meta.get("optimizer_step") is not None:
        meta["optimizer"] = {kind: params_from_rows([{**r.asDict(), "name": r["name"][6:]} for r in rows if r["name"].startswith(f"opt.{kind}.")])
                             for kind in ("m", "v")} | {"step": meta["optimizer_step"]}
    return Model(spec, params, meta)
