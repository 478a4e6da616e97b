"""Session settings, table loading and the shared working folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings an own session gets; a session that is handed in keeps its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.runSQLOnFiles": "false",
    "spark.ui.enabled": "false",
}


def session(app: str = "postlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; ``conf`` keys are given with ``_`` for ``.``."""
    b = SparkSession.builder.appName(app).config(map=DEFAULTS)
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("_", "."), v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a context, so that they need no copy of their own."""
    sc = spark.sparkContext
    if getattr(sc, "_postlake_shipped", False):
        return
    package = Path(__file__).resolve().parent
    held = tempfile.mkdtemp(prefix="postlake-ship-")
    atexit.register(shutil.rmtree, held, ignore_errors=True)
    with zipfile.ZipFile(f"{held}/postlake.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(f"{held}/postlake.zip")
    sc._postlake_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the setting is absent and the master is local does a temporary folder
    take its place; a cluster without the setting is refused.
    """
    sc = spark.sparkContext
    there = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    own = sc._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get().rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="postlake-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    sc.setCheckpointDir(made)
    return made


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system of a path and the path in it, whatever kind it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


_HELD: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed on any file system when the session's driver ends."""
    path = f"{shared_dir(spark)}/postlake-{label}-{uuid.uuid4().hex[:12]}"
    sc = spark.sparkContext
    if sc not in _HELD:
        _HELD[sc] = []
        atexit.register(_clean, weakref.ref(sc), spark)
    _HELD[sc].append(path)
    return path


def _clean(sc: weakref.ref, spark: SparkSession) -> None:
    for path in _HELD.get(sc(), []) if sc() is not None else []:
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001
            # The session has ended: what lies on a local disk can go without it.
            shutil.rmtree(Path(path.removeprefix("file://").removeprefix("file:")), ignore_errors=True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the lineage is cut and
    the files outlive any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the driver collect what nothing points at: Spark drops the shuffle files of finished steps only then."""
    gc.collect()
    spark._jvm.System.gc()
