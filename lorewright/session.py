"""Session helpers: reading tables and cutting lineage safely."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context.

    The driver serves the archive to every executor, also to ones that start later,
    so the workers need no copy of the code on their path.
    """
    sc = spark.sparkContext
    if getattr(sc, "_lorewright_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lorewright-code-")) / "lorewright.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._lorewright_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    The folder comes from ``spark.checkpoint.dir``. Where that is unset, a
    temporary folder is used in local mode only; on a cluster the caller must
    configure a folder that all executors share.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="lorewright-ckpt-")
        atexit.register(shutil.rmtree, folder, True)
    sc.setCheckpointDir(folder)


def shared_folder(spark: SparkSession) -> str:
    """The folder of checkpoints, for tables that all executors must reach."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition by keys before a costly Python step.

    Adaptive execution merges small partitions by their bytes; rows that are short but
    costly would end in a few tasks. A number given here stays.
    """
    spark = df.sparkSession
    n = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys)


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread a scan of fewer splits than there are cores over all of them; a larger one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
