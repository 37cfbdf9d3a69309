"""Session helpers: sessions for tests and bench, table loading, lineage cuts, code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, name: str = "vellumflow") -> SparkSession:
    """A local session for tests and bench; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # checkpoints go when nothing refers to them any more; a cluster sets this itself
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table: a parquet file or a folder of parquet files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, once a session.

    Nothing is sent when PYTHONPATH already leads there, as on a cluster where it is installed.
    """
    root = str(PACKAGE.parent)
    sc = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_vellumflow_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="vellumflow-")) / "vellumflow.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(PACKAGE.parent))
    sc.addPyFile(str(target))
    sc._vellumflow_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; only where none is named and all runs on this machine, one below /tmp."""
    sc = spark.sparkContext
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf is None:
        if not sc.master.startswith("local") and sc._jsc.sc().getCheckpointDir().isEmpty():
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf = "file://" + os.path.join(tempfile.gettempdir(), "vellumflow-checkpoints")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(conf)
    return conf


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder and reads it from there: lineage ends, lost executors don't matter."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
