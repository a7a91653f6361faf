"""Session construction and the shared scratch folder.

On a cluster the session is built by the launcher; this module only fills in
settings that are unset (local runs and tests) and never overrides what the
cluster configured.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied only when the session does not have them already.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def build_session(master: str | None = None, app: str = "martlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session; on a cluster use the launcher's session and
    call :func:`configure` on it instead."""
    master = master or os.environ.get("MARTLAKE_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("MARTLAKE_DRIVER_MEM", "16g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the defaults that are still unset and make sure a checkpoint
    folder exists."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    # Driver tables carry naive timestamps; pin the zone so event-time
    # arithmetic and the DuckDB oracle agree.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster names it; only when it is unset and the session is a local
    one, a folder of our own is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master if sc is not None else ""
        if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="martlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def written(df, name: str):
    """``df`` written once as Parquet in the shared scratch folder and read
    back: cuts the lineage and keeps statistics and column pruning."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written
    intermediate tables, stream checkpoints and sink round trips."""
    root = checkpoint_root(spark).rstrip("/")
    _SCRATCH.append(f"{root}/{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def clean_scratch(spark: SparkSession) -> int:
    """Drop the catalog tables and delete the scratch paths that this process
    made; to be called when their frames are no longer read. Returns the
    number of paths."""
    for db in spark.catalog.listDatabases():
        for t in spark.catalog.listTables(db.name):
            if t.isTemporary:
                continue
            at = spark.sql(f"DESCRIBE TABLE EXTENDED `{db.name}`.`{t.name}`").where("col_name = 'Location'").first()
            if at is not None and any(p.split(":")[-1].lstrip("/") in at["data_type"] for p in _SCRATCH):
                spark.sql(f"DROP TABLE IF EXISTS `{db.name}`.`{t.name}`")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = len(_SCRATCH)
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(conf).delete(path, True)
    return n
