"""Session defaults and the scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


DEFAULTS = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "snappy",
}


def get_session(app_name: str = "triptych", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides them.

    Results depend on the time zone and ANSI mode, which are always set.  The other
    values are defaults: what spark-submit was given stays.

    Cluster sizing (executors, memory, shuffle partitions) is left to
    spark-submit.  Inputs are split at 512 MB because every job here either is
    map-only or shrinks to one row per group before its first shuffle: fewer,
    longer map tasks mean fewer partial rows to merge and fewer output files.

    The JVM never compiles a method above 8000 bytes of bytecode.  The wide silver
    projections can pass that when the source columns are computed too, and then
    run about three times slower; with the limit below Spark generates smaller
    methods for such a stage instead.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    forced = {
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        **conf,
    }
    for key, value in forced.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not submitted.contains(key) and key not in conf:
            spark.conf.set(key, value)
    return spark


_scratch: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors share.

    Only a local session may do without that setting; it then gets a temporary
    folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    folder = f"{base.rstrip('/')}/triptych-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this application, once no result is read from them any more.

    Returns how many there were.  Call it at the end of a session that ran operators with
    intermediate tables; folders of other applications are left alone.
    """
    folders = _scratch.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(folders)
