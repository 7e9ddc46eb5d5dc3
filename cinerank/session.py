"""Session helpers: a local session for tests and benches, and the shared folders
(checkpoints, scratch output) that every job takes from the session's settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "cinerank", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench. On a cluster, build the session
    with the cluster's own settings instead; the library only reads them."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Uses the folder the cluster names in ``spark.checkpoint.dir``; only when
    that is unset (local tests) a fresh folder under the system temp dir is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf_dir:
        if not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; name a shared folder for checkpoints on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="cinerank-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the shared checkpoint folder for job output."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def stored_rows(df, name: str):
    """``df`` written as Parquet in the shared folder and read back: like a checkpoint it is computed once and outlives its
    executors, but in a fifth of the bytes or so. Its partitions are not kept."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for sessions started outside its folder without
    PYTHONPATH. Once per application; a cluster that installs the package doesn't need it."""
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    here = tempfile.mkdtemp(prefix="cinerank-ship-")  # on the driver; Spark copies it to the executors
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(here, "cinerank"), "zip", root, "cinerank"))


def clean_scratch(spark: SparkSession) -> None:
    """Delete the scratch output of this checkpoint folder, when no result that reads it is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(ensure_checkpoint_dir(spark), "scratch"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint in the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
