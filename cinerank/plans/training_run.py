"""End-to-end training run: load, encode, split, fit, evaluate, store.

    python -m cinerank.plans.training_run --data_dir DIR          # ::-delimited files
    python -m cinerank.plans.training_run --sf_dir /root/testdata/sf0.01   # derived fixture

Rows stay in executors throughout; only parameters (size of the network) and
metrics reach the driver. Output: ``<out_dir>/model`` (parameter table +
metadata) and ``<out_dir>/results`` (one JSON record).
"""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..model.spec import ModelSpec, param_count
from ..model.train import FitConfig, fit
from ..operators import evaluate as EV
from ..operators import features as FE
from ..operators import split as S
from ..session import stored_rows
from ..sources import dat
from ..sources.fixtures import load_fixture
from ..sources.model_store import save_model


def run_training(spark: SparkSession, ratings: DataFrame, users: DataFrame, movies: DataFrame,
                 out_dir: str, spec: ModelSpec | None = None, cfg: FitConfig | None = None,
                 train_ratio: float = 0.8) -> DataFrame:
    """Returns the one-row evaluation of the best epoch's model on the test split."""
    spec = spec or ModelSpec()
    cfg = cfg or FitConfig()
    t0 = time.time()
    feats = FE.build_features(ratings, users, movies, keep_keys=True).drop("genres")  # the mask says the same
    feats = stored_rows(S.with_split(feats, seed=cfg.seed, train_ratio=train_ratio), "features")  # joined once for training and evaluation
    train, test = (feats.where(F.col("split") == side).drop("split") for side in ("train", "test"))
    model = fit(train, spec, cfg, on_better=lambda m: save_model(spark, m, os.path.join(out_dir, "model")))
    save_model(spark, model, os.path.join(out_dir, "model"))  # with the history of all epochs
    metrics = EV.evaluate(test, model).first().asDict()
    record = {"config": {**spec.to_dict(), **model.meta["config"]}, "feature_dims": schema.feature_dims(),
              "param_count": param_count(spec), "epoch_losses": [m for _, m, _ in model.meta["history"]],
              "best_epoch": model.meta["epoch"], "evaluation": {"arrow": metrics},
              "wall_seconds": time.time() - t0}
    dat.write_metrics(spark, os.path.join(out_dir, "results"), record)
    return spark.createDataFrame(
        [(spec.model_type, int(model.meta["epoch"]), float(model.meta["train_loss"]), float(metrics["mse"]),
          float(metrics["rmse"]), float(metrics["mae"]), int(metrics["n"]))],
        "model_type string, best_epoch int, train_mse double, mse double, rmse double, mae double, n bigint")


def main(argv=None):
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--data_dir", help="folder with ratings.dat, users.dat, movies.dat")
    src.add_argument("--sf_dir", help="driver parquet folder (derived fixture tables)")
    p.add_argument("--out_dir", required=True)
    p.add_argument("--model_type", default="ncf", choices=["ncf", "neumf"])
    p.add_argument("--embed_dim", type=int, default=32)
    p.add_argument("--hidden_dims", type=int, nargs="+", default=[128, 64])
    p.add_argument("--dropout", type=float, default=0.3)
    p.add_argument("--num_epochs", type=int, default=10)
    p.add_argument("--batch_size", type=int, default=256)
    p.add_argument("--lr", type=float, default=1e-3)
    p.add_argument("--weight_decay", type=float, default=1e-5)
    p.add_argument("--rows_per_shard", type=int, default=60_000)
    p.add_argument("--averages_per_epoch", type=int, default=1)
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("cinerank-training-run").getOrCreate()
    from ..session import ensure_checkpoint_dir, ship_package
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    tables = dat.load_tables(spark, args.data_dir) if args.data_dir else load_fixture(spark, args.sf_dir)
    spec = ModelSpec(args.model_type, args.embed_dim, args.hidden_dims, args.dropout)
    cfg = FitConfig(num_epochs=args.num_epochs, batch_size=args.batch_size, lr=args.lr,
                    weight_decay=args.weight_decay, rows_per_shard=args.rows_per_shard, averages_per_epoch=args.averages_per_epoch)
    run_training(spark, *tables, out_dir=args.out_dir, spec=spec, cfg=cfg).show(truncate=False)


if __name__ == "__main__":
    main()
