"""Session helpers.

The library never creates a session on its own inside an operator; these
helpers are for scripts, tests and the bench. On a cluster the session comes
from the platform and only ``checkpoint_dir`` is used.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours gets. Shuffle partitions are sized by the
# caller (cores locally, data size / ~128 MB on a cluster); AQE then
# coalesces small partitions and splits skewed join partitions at run time.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Broadcast only what is below this size *as measured by the planner*;
    # all explicit broadcasts in the library are of tables with a proven bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "kiln", extra: dict | None = None) -> SparkSession:
    """A local session for tests, the bench and examples."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("KILN_DRIVER_MEMORY", "8g")))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting it on the context.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3,
    ...) and is used as it is. Only when it is unset -- local runs and tests --
    a fresh scratch folder is taken, never a fixed machine-local path.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) on a cluster")
        path = tempfile.mkdtemp(prefix="kiln-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Jobs in this block drop their shuffle files when they end."""
    before = spark.conf.get(_DROP, "false")
    spark.conf.set(_DROP, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder: computed once, read by
    several steps, and only read again after a lost executor. The shuffle files
    of the job are dropped with its end."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folder_names(spark: SparkSession, path: str, holding: str) -> list[str]:
    """Names of the folders in ``path`` that hold a file ``holding``; none if
    ``path`` is missing."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return [n for n in names if fs.exists(_file_system(spark, f"{path}/{n}/{holding}")[1])]


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that nothing reads any more."""
    for path in paths:
        fs, p = _file_system(spark, path)
        fs.delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``kiln`` importable in the Python workers (pandas UDFs and
    ``mapInPandas`` kernels refer to its functions): zip the package once per
    application and hand it to ``addPyFile``, as ``--py-files`` would. A
    cluster that installs the package on its executors loses nothing."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="kiln-pyfiles-"), "kiln.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
