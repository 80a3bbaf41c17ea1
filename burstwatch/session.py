"""Session and checkpoint helpers."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "burstwatch") -> SparkSession:
    """Session for tests and the local bench. On a cluster, build your own
    session; the library only needs ``spark.sql.session.timeZone=UTC`` for
    display of timestamps (all time arithmetic is on epoch seconds)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, taken from the session.

    ``spark.checkpoint.dir`` names a folder every executor can reach. Only in
    local mode, where it is unset, is a fresh scratch folder used instead."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) "
            "so lineage can be cut reliably on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="burstwatch-ckpt-"))
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``burstwatch`` available to Python workers (stateful streaming
    processors, batch model UDFs) wherever the driver runs from: the package
    is zipped once per application and handed to ``addPyFile``, which
    distributes it to every executor, and its code is pickled by value."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    # Some Python runners (the planning-time runner of transformWithState)
    # start without the added files on their path: pickle our classes and
    # functions by value so no import of the package is needed there.
    import burstwatch
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(burstwatch)
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="burstwatch-pkg-"), "burstwatch.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


_SCOPE = threading.local()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of a file system that Spark can reach, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_tables(spark: SparkSession):
    """Tables that ``cut_lineage`` stores inside the block are removed when it ends
    (but for those stored with ``keep``). Everything that is computed from them
    must have been written by then."""
    outer = getattr(_SCOPE, "root", None)
    _SCOPE.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    try:
        yield
    finally:
        root, _SCOPE.root = _SCOPE.root, outer
        remove_path(spark, root)


def cut_lineage(df: DataFrame, keep: bool = False) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and read it back: later jobs start from the files, which survive the
    loss of executors. (An eager ``checkpoint()`` of an unpersisted frame
    computes it twice: once to count, once to write.) Inside ``scratch_tables``
    the table goes when the block ends, unless ``keep``."""
    spark = df.sparkSession
    scope = None if keep else getattr(_SCOPE, "root", None)
    root = scope or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables"
    path = f"{root}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    # the schema is known: no footer-reading job to infer it
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage_by(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """As ``cut_lineage``, with the rows in buckets of ``key``: what groups or joins the
    table by it reads each bucket in one task and shuffles only its other side. The
    catalog knows the table just while it is written; the files stay in the folder."""
    spark = df.sparkSession
    root = getattr(_SCOPE, "root", None) or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables"
    name = uuid.uuid4().hex
    table = f"spark_catalog.default.burstwatch_{name}"
    df.write.bucketBy(buckets, key).option("path", f"{root}/{name}").saveAsTable(table)
    out = spark.read.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out
