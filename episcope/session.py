"""Session helpers: building a session, the shared checkpoint folder, lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_WRITTEN: dict[str, list[str]] = {}      # application -> intermediate tables
_SHIPPED: set[str] = set()               # applications whose executors have this package


def build_session(master: str | None = None, app: str = "episcope",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with the settings the library assumes (UTC clock, AQE on, no UI)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir``.  Only a local session without
    one (tests) gets ``fallback`` or a fresh temp folder; on a cluster that would be
    another folder on every machine, so there it is an error.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        path = fallback or tempfile.mkdtemp(prefix="episcope-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    This cuts the lineage like a reliable checkpoint (a lost executor re-reads the
    files instead of replaying the plan) but computes the frame once, stores it
    columnar and compressed, and later scans prune columns and push filters.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/episcope-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


def drop_intermediate(spark: SparkSession) -> int:
    """Delete the tables that :func:`cut_lineage` wrote in this application, once no result
    that reads them is needed any more.  Returns their number."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        _delete(spark, p)
    return len(paths)


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete the intermediate table that ``df`` reads (one that :func:`cut_lineage` returned)."""
    mine = _WRITTEN.get(spark.sparkContext.applicationId, [])
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        for p in [p for p in mine if folder.endswith(p.rsplit("/", 1)[-1])]:
            _delete(spark, p)
            mine.remove(p)


def _delete(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per application), for clusters
    on whose machines it is not installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="episcope-code-")) / f"{top.name}.zip"    # the driver's copy, which Spark serves
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def default_parallelism(spark: SparkSession) -> int:
    """Partition count used by the order-sensitive operators."""
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    except Exception:  # pragma: no cover - conf always present in practice
        return max(1, os.cpu_count() or 1)
