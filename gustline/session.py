"""Spark session settings and the shared folder used to cut lineage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
#: Bytes of files that a task scans at most; a session that asks for less keeps its own.
SCAN_BYTES = 16 << 20
#: Routes of a batch at most, whose files a task keeps open together.
MOST_ROUTES = 9
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: dict[str, str] = {}
_freeing: dict[int, list] = {}  # by session: how many blocks are open, and the setting before the first
_freeing_lock = threading.Lock()


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the pipelines rely on; all can change at run time.

    Typing 37 columns makes one generated method of more than 8000 bytes, which the JVM
    then never compiles; below that limit Spark splits the code instead (several times
    faster here). Event times carry no zone, so the session must not shift them.

    Stored events take about 20 bytes a row but 600 in a task's hash table or sort, so a
    scan of the usual 128 MB would hold gigabytes and spill; it reads SCAN_BYTES at most.
    Batches have a few routes, whose files are kept open together instead of sorting the rows.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(MOST_ROUTES))
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if bytes_of(spark.conf.get(SPLIT_BYTES)) > SCAN_BYTES:
        spark.conf.set(SPLIT_BYTES, str(SCAN_BYTES))
    return spark


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in this block drop their shuffle files when they end.

    They would stay until the driver happens to collect its garbage, next to those of every later step.
    Rows that are read again are shuffled again, so it is meant for steps that store what they make.
    """
    with _freeing_lock:
        held = _freeing.setdefault(id(spark), [0, spark.conf.get(SHUFFLE_CLEANUP, None)])
        held[0] += 1
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            held[0] -= 1
            if not held[0]:
                before = _freeing.pop(id(spark))[1]
                if before is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, before)


def local_session(cpus: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the session comes from outside."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gustline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; it must outlive any executor."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="gustline-")
        folder = _local_folders[app]
    return folder.rstrip("/")


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that reliable checkpoints of iterative learners go to; set if the session has none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(spark)}/gustline-checkpoints")
    return context.getCheckpointDir()


def staging_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/gustline/{spark.sparkContext.applicationId}"


def staged_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but stays columnar, so each later
    reader scans only its own columns and the optimizer sees the true size.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Remove every staged table of this application."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
