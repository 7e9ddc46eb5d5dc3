"""``fit``: data-parallel training on shards, averaging parameters or, step by step, gradients.

Shape of the job
----------------
* The training rows (5 small ints + rating) are hash-partitioned into shards of about
  ``rows_per_shard`` rows, packed into blocks of bytes (36 a row) and written as a reliable
  checkpoint in the shared checkpoint folder: a lost executor recomputes a shard from
  the checkpoint, not from the joins. A task holds one shard, or where there are many, up to ``fan_in`` that follow each other.
* Per job the driver broadcasts the parameters, Adam moments and step count
  (size fixed by the network). Each shard is read in a fresh order -
  by xxhash64(row key, epoch), then all columns, sorted in Python - and mini-batch Adam runs over it; a task holds the
  blocks of one shard (and one Arrow batch) at a time.
* ``sync="epoch"``: local SGD. Each shard gives one array (rows, loss, steps, parameters and moments, times its rows); a task emits the sum of
  its shards', and ``tree_sum`` adds groups of ``fan_in`` arrays level by level, in the order of the shards: a task is one shuffled row,
  ``fan_in`` arrays are held at a time, and only the sum (size of the network) reaches the driver. ``averages_per_epoch`` times an epoch; raise
  it with the number of shards.
* ``sync="step"``: synchronous SGD. Where a network without batch normalisation takes one step an epoch over all rows (one replica), the step is
  a plain sum over the rows: each task adds up the gradients of its Arrow batches, ``tree_sum`` adds up the tasks, and the driver makes
  the update; no task holds the batch. Else an epoch is one barrier stage. A row's step and its replica (one of ``replicas`` parts of each batch, which
  batch normalisation sees alone) are hashes of its key, so they are the same on any number of workers, and so is the result. In each step
  the workers exchange their replicas' summed gradients, loss and running moments with one ``allGather`` and make the same update. If one task
  fails, Spark runs the whole stage again from the parameters of the epoch's start. The exchange passes the driver (workers squared
  times the network's size), and Spark looks for its end once a second: take few workers and large batches. The workers need as many
  free slots at once.
"""

from __future__ import annotations

import base64
import itertools
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tree import tree_sum
from ..session import cut_lineage, stored_rows
from . import kernel as K
from .score import Model
from .spec import ModelSpec, flatten, init_params, unflatten

TRAIN_COLS = ["gender_idx", "age_idx", "occ_idx", "zip_idx", "genre_mask", "rating"]


@dataclass
class FitConfig:
    num_epochs: int = 10
    batch_size: int = 256
    lr: float = 1e-3
    weight_decay: float = 1e-5
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    max_grad_norm: float = 1.0
    min_lr_ratio: float = 0.01
    rows_per_shard: int = 60_000
    averages_per_epoch: int = 1
    fan_in: int = 16
    sync: str = "epoch"
    sync_workers: int = 8
    replicas: int = 8
    seed: int = 42
    clamp_in_training: bool = False
    out_bias_from_mean: bool = True

    def __post_init__(self):
        if self.sync not in ("epoch", "step"):
            raise ValueError(f"sync is 'epoch' or 'step', not {self.sync!r}")


def _keyed_rows(train: DataFrame, n: int | None = None) -> tuple[DataFrame, int]:
    """Training columns with a hash of each row's key, stored (unless their number ``n`` is given), and their number. Fewer than two are an error."""
    key_cols = [c for c in ("user_id", "movie_id", "ts") if c in train.columns] or TRAIN_COLS
    rows = train.select(*[F.col(c) for c in TRAIN_COLS[:-1]], F.col("rating").cast("double").alias("rating"), F.xxhash64(*key_cols).alias("_rk"))
    if n is None:
        rows = stored_rows(rows, "training-rows")
        n = rows.count()
    if n < 2:
        raise ValueError(f"cannot train on {n} rows: batches are normalised, which takes two at least")
    return rows, n


#: Tasks that an epoch is divided into before a task gets more than one shard.
LEAST_TASKS = 128
PACKED = "_shard long, rows binary"
ROW_BYTES = 36


def shards_per_task(n_shards: int, fan_in: int) -> int:
    """Shards that follow each other in one task: a power of two up to ``fan_in``, by the number of shards only, so that sums are the same on any cluster."""
    k = 1
    while 2 * k <= fan_in and n_shards // (2 * k) >= LEAST_TASKS:
        k *= 2
    return k


def prepare_shards(train: DataFrame, rows_per_shard: int, fan_in: int = 16, n: int | None = None) -> DataFrame:
    """Training rows hash-partitioned into shards of about ``rows_per_shard`` rows, packed and checkpointed.
    The shard of a row depends on its key only. ``n``: the number of rows, if they are stored and counted already."""
    rows, n = _keyed_rows(train, n)
    return _shards(rows, n, rows_per_shard, fan_in)


def _shards(rows: DataFrame, n: int, rows_per_shard: int, fan_in: int) -> DataFrame:
    n_shards = max(1, round(n / rows_per_shard))
    k = shards_per_task(n_shards, fan_in)
    shard = F.pmod(F.hash("_rk"), F.lit(n_shards))  # as a hash partitioning by _rk deals rows
    return cut_lineage(rows.withColumn("_shard", shard).repartitionById(-(-n_shards // k), F.floor(F.col("_shard") / k).cast("int"))
                       .sortWithinPartitions("_shard").mapInArrow(_packed, PACKED))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each run of one shard's rows in a batch: keys, ratings and the five features, a column after the other, as bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        if any(batch.column(c).null_count for c in TRAIN_COLS[:4]):
            raise ValueError("a training row lacks a feature")
        shard, keys, ratings, *features = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_shard", "_rk", "rating", *TRAIN_COLS[:4]))
        features.append(batch.column("genre_mask").fill_null(0).to_numpy())  # no genres
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1), len(shard)]
        blocks = [b"".join([keys[i:j].astype(np.int64).tobytes(), ratings[i:j].astype(np.float64).tobytes(), *(f[i:j].astype(np.int32).tobytes() for f in features)])
                  for i, j in itertools.pairwise(cuts)]
        yield pa.RecordBatch.from_arrays([pa.array(shard[cuts[:-1]], pa.int64()), pa.array(blocks, pa.binary())], names=["_shard", "rows"])


def _unpacked(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, ratings, features) of a shard, from its blocks."""
    parts = ([], [], [])
    for block in blocks:
        n = len(block) // ROW_BYTES
        parts[0].append(np.frombuffer(block, np.int64, n))
        parts[1].append(np.frombuffer(block, np.float64, n, 8 * n))
        parts[2].append(np.frombuffer(block, np.int32, 5 * n, 16 * n).reshape(5, n))
    return np.concatenate(parts[0]), np.concatenate(parts[1]), np.concatenate(parts[2], axis=1)


def _turns(keys: np.ndarray, epoch: int) -> np.ndarray:
    """Spark's xxhash64(keys, epoch), for a long and an int."""
    one, two, three, four, five = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def rotated(x, bits):
        return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))

    def mixed(x):
        x = (x ^ (x >> np.uint64(33))) * two
        x = (x ^ (x >> np.uint64(29))) * three
        return x ^ (x >> np.uint64(32))

    with np.errstate(over="ignore"):
        x = (np.uint64(42 + 8) + five) ^ (rotated(keys.view(np.uint64) * two, 31) * one)
        x = mixed(rotated(x, 27) * one + four)
        x = (x + five + np.uint64(4)) ^ (np.uint64(epoch) * one)
        return mixed(rotated(x, 23) * two + three).view(np.int64)


def _order(turns: np.ndarray, ratings: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Rows by their turn; those with one turn by all columns."""
    order = np.argsort(turns)
    ranked = turns[order]
    same = ranked[1:] == ranked[:-1]
    tied = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    if tied.any():
        some = order[tied]
        order[tied] = some[np.lexsort((ratings[some], *(f[some] for f in features[::-1]), turns[some]))]
    return order


def prepare_replicas(train: DataFrame, replicas: int, workers: int) -> DataFrame:
    """Training rows with the replica of each (_replica, by its key), whole replicas on each of ``workers`` partitions, checkpointed."""
    return _replicas(_keyed_rows(train)[0], replicas, workers)


def _replicas(rows: DataFrame, replicas: int, workers: int) -> DataFrame:
    rows = rows.withColumn("_replica", F.pmod(F.xxhash64("_rk", F.lit("replica")), F.lit(replicas)).cast("int"))
    return cut_lineage(rows.repartitionById(min(workers, replicas), F.col("_replica") % min(workers, replicas)))


#: Rows whose features are spelled out at a time.
CHUNK = 4096


def _epoch_job(shards: DataFrame, bc, epoch: int, part: int, lr: float, cfg: FitConfig) -> DataFrame:
    def trained(shard: int, blocks: list[bytes]) -> np.ndarray | None:
        """What a shard's steps end at: (rows, loss, 1, steps, parameters, moments) times its rows; None without a step."""
        keys, ratings, features = _unpacked(blocks)
        turns = _turns(keys, epoch)
        if cfg.averages_per_epoch > 1:
            mine = turns % cfg.averages_per_epoch == part
            turns, ratings, features = turns[mine], ratings[mine], features[:, mine]
        order = _order(turns, ratings, features)
        y, features = ratings[order], features[:, order].astype(np.int64)
        spec, P0, M0, V0, t, names, bufs = bc.value
        adam = K.FlatAdam(P0, M0, V0, spec, names)
        P = {**P0, **adam.params}
        rng = np.random.default_rng([cfg.seed, epoch, part, shard])
        rows, B, scratch = len(y), cfg.batch_size, {}
        cuts = [*range(0, rows, B), rows]
        if rows % B == 1:  # a batch of one cannot be normalised
            del cuts[-2]
            rows -= rows == 1
        if not rows:
            return None
        loss, t0, chunk, start = 0.0, t, None, 0
        for i, j in itertools.pairwise(cuts):
            if not spec.hidden_dims:
                step, _ = K.loss_and_grads(P, spec, *features[:4, i:j], K.multihot(features[4, i:j]), y[i:j], rng=rng, bn_stats=P,
                                           clamp_in_training=cfg.clamp_in_training, out=adam.grads, scratch=scratch)
            else:
                if chunk is None or j > start + len(chunk):
                    start = i
                    chunk = K.design(P, spec, *features[:, i:max(j, i + CHUNK // B * B)])
                step = K.train_step(P, spec, chunk[i - start:j - start], y[i:j], rng, P, adam.grads, scratch, cfg.clamp_in_training)
            loss += step
            t += 1
            adam.step(t, lr, (cfg.beta1, cfg.beta2), cfg.eps, cfg.weight_decay, cfg.max_grad_norm)
        vec = np.concatenate([flatten(P, names + bufs), flatten(adam.M, names), flatten(adam.V, names)]) * rows
        return np.concatenate([[rows, loss / (t - t0), 1.0, t * rows], vec])

    def run(batches):
        from pyspark import TaskContext

        blocks = ((s, b) for batch in batches for s, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        total = None
        for shard, held in itertools.groupby(blocks, key=lambda x: x[0]):
            vec = trained(shard, [b for _, b in held])
            if vec is not None:
                total = vec if total is None else np.add(total, vec, out=total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.ListArray.from_arrays(pa.array([0, len(total)], pa.int32()), pa.array(total))], names=["_id", "v"])

    return shards.mapInArrow(run, "_id long, v array<double>")


def _step_job(shards: DataFrame, bc, epoch: int, n_steps: int, lr: float, cfg: FitConfig) -> DataFrame:
    """One epoch of synchronous steps in a barrier stage; the first worker emits the result, which all share."""
    turn = F.xxhash64("_rk", F.lit(epoch))
    ordered = (shards.withColumn("_step", F.pmod(turn, F.lit(n_steps))).sortWithinPartitions("_step", "_replica", turn, *TRAIN_COLS)
               .select("_step", "_replica", turn.alias("_turn"), *TRAIN_COLS))

    def by_step(batches):
        """The rows of step 0, 1, ... on this worker; none is an empty list."""
        at, held = 0, []
        for pdf in batches:
            for s, part in pdf.groupby("_step"):
                while at < s:
                    yield held
                    at, held = at + 1, []
                held.append(part)
        while at < n_steps:
            yield held
            at, held = at + 1, []

    def run(batches):
        import pandas as pd
        from pyspark import BarrierTaskContext

        spec, P, M, V, t, names, bufs = bc.value
        P, M, V = ({n: v.copy() for n, v in x.items()} for x in (P, M, V))
        size = len(flatten(P, names)) + len(flatten(P, bufs)) if bufs else len(flatten(P, names))
        context = BarrierTaskContext.get()

        def summed(vec):
            sent = context.allGather(base64.b64encode(vec.tobytes()).decode())
            return np.stack([np.frombuffer(base64.b64decode(x)) for x in sent]).sum(0)

        rows, loss, steps = 0, 0.0, 0
        for held in by_step(batches):
            mine = np.zeros(2 + size)
            for _, part in pd.concat(held).groupby("_replica") if held else ():
                n = len(part)
                if n < 2:
                    continue  # a replica of one row cannot be normalised
                g, a, o, z, mask = (part[c].to_numpy(np.int64) for c in TRAIN_COLS[:5])
                seen = {b: P[b].copy() for b in bufs}
                err, G = K.loss_and_grads(P, spec, g, a, o, z, K.multihot(mask), part["rating"].to_numpy(np.float64), bn_stats=seen,
                                          rng=K.KeyedDraws(part["_turn"].to_numpy(), cfg.seed), clamp_in_training=cfg.clamp_in_training)
                mine += n * np.concatenate([[1.0, err], flatten(G, names), *([flatten(seen, bufs)] if bufs else [])])
            total = summed(mine)
            n = total[0]
            if not n:
                continue
            total = total / n
            G = unflatten(total[2:], spec, names)
            if bufs:
                P.update(unflatten(total[size + 2 - len(flatten(P, bufs)):], spec, bufs))
            K.clip_grad_norm(G, cfg.max_grad_norm)
            steps += 1
            K.adam_step(P, G, M, V, t + steps, lr, (cfg.beta1, cfg.beta2), cfg.eps, cfg.weight_decay)
            loss, rows = loss + total[1], rows + int(n)
        if rows and context.partitionId() == 0:
            yield pd.DataFrame({"_id": [0], "v": [np.concatenate([[1.0, loss, steps, t + steps], flatten(P, names + bufs), flatten(M, names), flatten(V, names)])]})

    # The shuffle makes the barrier stage one that Spark can run again: it gives up on a failed barrier stage that ends a job.
    return ordered.mapInPandas(run, "_id long, v array<double>", barrier=True).repartition(1)


def _sum_job(rows: DataFrame, bc, cfg: FitConfig) -> DataFrame:
    """Rows, loss and gradients of one step over all rows, added up by task. For networks without batch normalisation, in which rows
    don't depend on each other."""
    def run(batches):
        import pandas as pd
        from pyspark import TaskContext

        spec, P, *_, names, _ = bc.value
        total = None
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            g, a, o, z, mask = (pdf[c].to_numpy(np.int64) for c in TRAIN_COLS[:5])
            loss, G = K.loss_and_grads(P, spec, g, a, o, z, K.multihot(mask), pdf["rating"].to_numpy(np.float64), clamp_in_training=cfg.clamp_in_training)
            part = n * np.concatenate([[1.0, loss], flatten(G, names)])
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"_id": [TaskContext.get().partitionId()], "v": [total]})

    return rows.select(*TRAIN_COLS).mapInPandas(run, "_id long, v array<double>")


def _stepped(total: np.ndarray, P: dict, M: dict, V: dict, t: int, spec: ModelSpec, names: list, lr: float, cfg: FitConfig) -> np.ndarray:
    """What ``_step_job`` emits, after one step by the sums of ``_sum_job``."""
    n = total[0]
    G = {k: v.copy() for k, v in unflatten(total[2:] / n, spec, names).items()}
    K.clip_grad_norm(G, cfg.max_grad_norm)
    P, M, V = dict(P), dict(M), dict(V)
    K.adam_step(P, G, M, V, t + 1, lr, (cfg.beta1, cfg.beta2), cfg.eps, cfg.weight_decay)
    return np.concatenate([[1.0, total[1] / n, 1.0, t + 1], flatten(P, names), flatten(M, names), flatten(V, names)])


def fit(train: DataFrame, spec: ModelSpec, cfg: FitConfig | None = None, init: Model | None = None,
        shards: DataFrame | None = None, on_better=None) -> Model:
    """Train ``spec`` on a feature DataFrame (gender_idx, age_idx, occ_idx, zip_idx,
    genre_mask, rating; rating keys used for sharding when present).

    Returns the model of the epoch with the lowest training loss: its parameters, the Adam state
    of the same epoch, and ``meta['history']`` = [(epoch, mse, lr)]. ``on_better(model)`` is called after
    each epoch that is better than all before (to store it: a lost driver then loses one epoch). ``init``
    goes on from a stored model: parameters, Adam state, the epochs done and their history. ``shards``: of ``train``, by
    :func:`prepare_shards` (or :func:`prepare_replicas` with ``sync="step"``).
    """
    cfg = cfg or FitConfig()
    spark = train.sparkSession
    stepwise = cfg.sync == "step"
    names, bufs = spec.trainable_names(), spec.buffer_names()
    one_sum = False
    if not stepwise:
        rows = train
        if shards is None:
            rows, n = _keyed_rows(train)
            shards = _shards(rows, n, cfg.rows_per_shard, cfg.fan_in)
        n_steps = 0
    else:
        rows, n = _keyed_rows(train) if shards is None else (shards, shards.count())
        n_steps = max(1, -(-n // (cfg.batch_size * cfg.replicas)))
        one_sum = n_steps == 1 and cfg.replicas == 1 and not bufs
        workers = min(cfg.sync_workers, spark.sparkContext.defaultParallelism)
        shards = rows if one_sum or shards is not None else _replicas(rows, cfg.replicas, workers)
    n_parts = shards.rdd.getNumPartitions()
    opt = (init.meta.get("optimizer") if init else None) or {}
    if init:
        P = init.params
    else:
        out_bias = float((shards if stepwise else rows).agg(F.avg(F.col("rating").cast("double").cast("decimal(20,6)"))).first()[0]) if cfg.out_bias_from_mean else None
        P = init_params(spec, cfg.seed, out_bias)
    M = opt.get("m") or {n: np.zeros_like(P[n]) for n in names}
    V = opt.get("v") or {n: np.zeros_like(P[n]) for n in names}
    t = int(opt.get("step") or 0)
    n_p, n_t = len(flatten(P, names + bufs)), len(flatten(M, names))
    done = int(init.meta.get("epoch", 0)) if init else 0
    history = [tuple(h) for h in init.meta.get("history", [])][:done] if init else []
    best = init if init and history else None
    for epoch in range(done, cfg.num_epochs):
        lr = K.cosine_lr(epoch, cfg.num_epochs, cfg.lr, cfg.min_lr_ratio)
        loss = batches = 0.0
        for part in range(1 if stepwise else cfg.averages_per_epoch):
            bc = spark.sparkContext.broadcast((spec, P, M, V, t, names, bufs))
            if one_sum:
                summed = [{"v": _stepped(np.array(r["v"]), P, M, V, t, spec, names, lr, cfg)}
                          for r in tree_sum(_sum_job(shards, bc, cfg), n_parts, cfg.fan_in).collect()]
            elif stepwise:
                summed = _step_job(shards, bc, epoch, n_steps, lr, cfg).collect()
            else:
                summed = tree_sum(_epoch_job(shards, bc, epoch, part, lr, cfg), n_parts, cfg.fan_in).collect()
            bc.destroy()
            if not summed:
                continue  # a part without rows
            vec = np.array(summed[0]["v"])
            n_rows, loss, batches = vec[0], loss + vec[1], batches + vec[2]
            t = int(round(vec[3] / n_rows))
            vec = vec[4:] / n_rows
            P = unflatten(vec[:n_p], spec, names + bufs)
            M = unflatten(vec[n_p:n_p + n_t], spec, names)
            V = unflatten(vec[n_p + n_t:], spec, names)
        mse = float(loss / max(batches, 1.0))
        history.append((epoch + 1, mse, float(lr)))
        if best is None or mse < best.meta["train_loss"]:
            best = Model(spec, {k: v.copy() for k, v in P.items()}, {
                "epoch": epoch + 1, "train_loss": mse, "history": list(history), "config": asdict(cfg),
                "optimizer": {"m": M, "v": V, "step": t}, **spec.to_dict()})
            if on_better:
                on_better(best)
    best.meta["history"] = history
    return best


def learning_curve(spark, model: Model, test_rmse: float | None = None) -> DataFrame:
    """epoch, train MSE, train RMSE (= sqrt MSE), learning rate and the test RMSE line."""
    rows = [(int(e), float(m), float(math.sqrt(m)), float(lr), test_rmse)
            for e, m, lr in model.meta.get("history", [])]
    return spark.createDataFrame(rows, "epoch int, train_mse double, train_rmse double, lr double, test_rmse double")
