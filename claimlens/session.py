"""Spark session builder and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "claimlens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with ANSI, AQE and UTC settings.

    On a cluster pass ``master=None`` so the launcher's settings win; tests pass
    ``local[*]`` and a small shuffle-partition count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "8g"  # leaves room for the Python workers
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    limit_methods(spark)
    checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they can
    import it from any working folder and on any machine."""
    sc = spark.sparkContext
    if getattr(sc, "_claimlens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="claimlens-code-"), "claimlens.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.join("claimlens", os.path.relpath(os.path.join(folder, n), root)))
    sc.addPyFile(path)
    sc._claimlens_shipped = True


def limit_methods(spark: SparkSession) -> None:
    """Lower Spark's bound on generated methods to what HotSpot compiles, unless the session sets one of its own. Wide row-wise
    work (a raw table typed, amounts parsed) fused into one method beyond 8,000 bytes of bytecode is only interpreted."""
    if spark.conf.get(METHOD_LIMIT) == "65535":  # Spark's default: the largest method that Java knows
        spark.conf.set(METHOD_LIMIT, "8000")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and we only read it. Only
    when it is unset (local tests) a fresh local folder is created and installed.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    jsc = spark.sparkContext._jsc
    current = jsc.sc().getCheckpointDir()
    if not d and not current.isEmpty():
        d = current.get()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: on a cluster it must name a folder that the driver "
                               "and all executors share")
        d = tempfile.mkdtemp(prefix="claimlens-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core confs may be read-only at runtime
            pass
    if current.isEmpty():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never machine-local)."""
    base = checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage with a reliable checkpoint written under ``spark.checkpoint.dir``
    (shared storage on a cluster, so a lost executor does not lose it). Used
    between stages of long compositions whose scalar statistics would otherwise
    replay the whole upstream plan."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str = "stored"):
    """The rows written as Parquet below ``spark.checkpoint.dir`` and read again. Later passes read only the
    columns they use and replay nothing; encoded columns take a fraction of a checkpoint's rows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def joinable(groups):
    """A table of one row per group, to be joined back on its key. It is written below
    ``spark.checkpoint.dir`` and read again: joined directly, an aggregate keeps its partitioning, so that no exchange
    stands on its side of the join, and AQE can't split a hot key there. (A checkpoint would keep it too.)"""
    return stored(groups, "groups")


__all__ = ["limit_methods", "joinable", "stored", "get_session", "checkpoint_dir", "scratch_path", "ship_package", "materialize"]
