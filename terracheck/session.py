"""Session helpers: a local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "terracheck") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # remove checkpoint files once their DataFrames are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only a local master may get a temp one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder (HDFS/S3/ABFS) "
            "so lineage cuts survive executor loss"
        )
    path = tempfile.mkdtemp(prefix="terracheck-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row of ``df``.

    The one-row side (a global median, min/max, counts) is computed once and
    broadcast; its size is fixed at one row, so the big side is streamed without
    a shuffle and nothing is multiplied."""
    return df.crossJoin(F.broadcast(one_row))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``terracheck`` importable by the Python workers of this application.

    Pandas UDFs and grouped-map functions are pickled by reference to this package, so
    executors must be able to import it: zip the package source and ``addPyFile`` it once
    per application (Spark distributes the file to every executor)."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zip_path = os.path.join(tempfile.mkdtemp(prefix="terracheck-pkg-"), "terracheck.zip")
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zip_path)
    _SHIPPED.add(app)
