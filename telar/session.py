"""Session helpers: code shipping, the shared folder, cutting of lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession


def get(name: str = "telar", cores: str = "8", **conf: str) -> SparkSession:
    """A local session with the settings that the engine expects (tests, bench)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in (base | conf).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.join(SparkFiles.getRootDirectory(), f"ship-{uuid.uuid4().hex[:8]}")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "telar_pkg.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    z.write(full, os.path.join("telar", os.path.relpath(full, root)))
    sc.addPyFile(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``; a temporary one only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        base = getattr(shared_dir, "own", None)
        if base is None:
            base = shared_dir.own = tempfile.mkdtemp(prefix="telar-")
    return f"{base.rstrip('/')}/telar-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the application may be gone already
        pass


_roots: set[str] = set()


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and a lost executor costs nothing."""
    spark = df.sparkSession
    root = shared_dir(spark)
    if root not in _roots:
        _roots.add(root)
        atexit.register(_delete, spark, root)
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._telar_path = path
    return back


def drop(df: DataFrame) -> None:
    """Delete what ``store`` wrote, once nothing reads it any more."""
    path = getattr(df, "_telar_path", None)
    if path:
        _delete(df.sparkSession, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
