"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import gc
import json
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What written tables are compressed by: about a third smaller than by Spark's default, a few percent of it by the level.
CODEC = "zstd"
CODEC_LEVEL = 9
# Columns of many values that repeat from row to row, as those of a game's appearances do. A dictionary packs their numbers
# into a few bits each, in which the codec finds no repeats, so they are written as they are.
IN_RUNS = ("game_id", "player_id", "player_sk", "player_name")

# Local sessions without a configured folder get one per process.
_local_dir: str | None = None


def build_session(app: str = "strataline", cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Recording a call site for every Column costs more than planning wide tables does.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder is only used by a local session that has none set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="strataline-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


# Scratch folders of this process that no staging() block removes earlier.
_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder; it is removed when the process ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_remove_scratch)
    _scratch.append(path)
    return path


def remove(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete folders that nothing refers to."""
    _remove(paths, spark.sparkContext._jsc.hadoopConfiguration())


def _remove(paths: Sequence[str], conf=None) -> None:
    jvm = SparkContext._jvm
    conf = conf or jvm.org.apache.hadoop.conf.Configuration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def _remove_scratch() -> None:
    # The session may be stopped by now; its JVM lives as long as the process.
    with suppress(Exception):
        _remove(_scratch)


def control_table(spark: SparkSession, rows: Sequence[Sequence[object]], ddl: str) -> DataFrame:
    """A few rows held by the driver (ledger entries, a register) as a DataFrame.

    They travel as one JSON literal, so no Python worker is started for them.
    """
    schema = T.StructType.fromDDL(ddl)
    records = json.dumps([dict(zip(schema.names, r, strict=True)) for r in rows], default=str)
    parsed = F.from_json(F.lit(records), T.ArrayType(schema))
    return spark.range(1).select(F.inline(parsed))


def parquet_writer(df: DataFrame, in_runs: Sequence[str] = IN_RUNS) -> DataFrameWriter:
    """The writer of a table's files; ``in_runs`` are columns to keep out of dictionaries."""
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in in_runs if c in df.columns}
    return df.write.options(**{"compression": CODEC, "parquet.compression.codec.zstd.level": str(CODEC_LEVEL)} | plain)


# Paths written by stage() inside the innermost staging() block of this context.
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def stage(
    df: DataFrame, label: str = "stage", spark: SparkSession | None = None, in_runs: Sequence[str] = IN_RUNS
) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where a result is read several times or must not be recomputed differently: it cuts lineage,
    survives the loss of executors, and later reads prune columns. ``spark`` is the session that goes on, if it is
    not the one ``df`` was made in; ``in_runs`` is as in ``parquet_writer``.
    """
    spark = spark or df.sparkSession
    path = scratch_path(spark, label)
    parquet_writer(df, in_runs).parquet(path)
    paths = _staged.get()
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def free_unused(spark: SparkSession) -> None:
    """Let go of what finished steps of a job left in the driver and, by it, in the executors.

    Shuffles and broadcasts of earlier queries go only when the driver's collector meets them, which a driver of small
    tables and many queries seldom does by itself: its heap grows instead, and executors keep the files. Called between
    the steps of a job; some of what a step left goes with the call after the next step.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _give_back(spark)


def _give_back(spark: SparkSession) -> bool:
    """Have the C library return what the threads of finished queries freed, of which it keeps a share for every thread.

    As ``jcmd System.trim_native_heap`` does; says whether this JVM knows how.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    # The server's own class is not public, so the method is that of its interface.
    methods = jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods()
    arguments = gateway.new_array(jvm.java.lang.Object, 4)
    arguments[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    arguments[1] = "systemTrimNativeHeap"
    with suppress(Py4JError):
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        next(m for m in methods if m.getName() == "invoke").invoke(server, arguments)
        return True
    return False


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged inside the block when it ends. Results must be written by then."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        _remove(paths, spark.sparkContext._jsc.hadoopConfiguration())
