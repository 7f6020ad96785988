"""Shared helpers of the training-data operators: the shared folder, tables, digests."""

from __future__ import annotations

import contextlib
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE_WORD = r"[^\x20\x09-\x0D]+"      # words between ASCII white space


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark from whatever store ``sf_dir`` names."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    A local session may go without one (tests); a cluster may not.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile
    path = tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` once nothing reads it any more."""
    spark = df.sparkSession
    paths = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for path in paths:
        if "/llm-" in path:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Frames made meanwhile drop their shuffle files as soon as they have run."""
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, old)


def ascii_lower(col):
    """Lower case for A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_bucket(doc_id, n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def private(columns: list[str], *names: str) -> list[str]:
    """``names``, with underscores added until no column bears them (names are compared without case)."""
    taken, tail = {c.lower() for c in columns}, ""
    while any(f"{n}{tail}".lower() in taken for n in names):
        tail += "_"
    return [n + tail for n in names]


def row_key(doc_id, text):
    """Key of a document that does not depend on partitions: rows that share it are equal."""
    return F.xxhash64(doc_id, F.length(text), text, F.lit(17))


def extended(schema: T.StructType, **kinds: T.DataType) -> T.StructType:
    """``schema`` with further fields."""
    return T.StructType([*schema.fields, *(T.StructField(k, v) for k, v in kinds.items())])


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Send this subpackage's code to the executors, once a session, so that tasks can import it.

    Rows reach Python in batches of 8 MB (or one row, where that is longer) instead of Spark's 64,
    unless the session's settings name a size: texts are long, and a batch is in memory several times.
    """
    sc = spark.sparkContext
    if not sc.getConf().contains(BATCH_BYTES):
        spark.conf.set(BATCH_BYTES, "8m")
    if not getattr(sc, "_llm_shipped", False):
        import os
        import tempfile
        import zipfile
        here = os.path.dirname(os.path.abspath(__file__))
        package = os.path.dirname(here)
        name = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), "cellwatch_llm.zip")
        with zipfile.ZipFile(name, "w") as z:
            z.write(os.path.join(package, "__init__.py"), "cellwatch/__init__.py")
            for f in sorted(os.listdir(here)):
                if f.endswith(".py"):
                    z.write(os.path.join(here, f), f"cellwatch/llm/{f}")
        sc.addPyFile(name)
        sc._llm_shipped = True
    return spark


def release_memory() -> None:
    """Give what Arrow and the C library keep for later use back to the system: workers stay
    between tasks, and an idle one should be small."""
    import ctypes

    import pyarrow
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):                      # another C library
        pass


def release_driver_memory(spark: SparkSession) -> None:
    """Let go of what finished steps left on the driver. Broadcasts and plans stay until the JVM collects its garbage,
    which it puts off while its heap may grow; and what its threads and compilers have freed the C library keeps, 100 MB
    and more after many short jobs. For use between steps: 0.4 s on a heap of 750 MB."""
    import gc
    gc.collect()                                           # frames that Python still holds hold theirs in the JVM
    release_memory()
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    lang = jvm.java.lang
    lang.System.gc()
    # As ``jcmd <pid> System.trim_native_heap`` does.
    kinds, given = array(lang.Class, 4), array(lang.Object, 4)
    for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[i] = lang.Class.forName(kind)
    given[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    given[1] = "systemTrimNativeHeap"
    invoke = lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds)
    with contextlib.suppress(Py4JError):                   # a JVM before 17.0.9, or another C library
        invoke.invoke(lang.management.ManagementFactory.getPlatformMBeanServer(), given)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` of a function of this subpackage."""
    def run(batches):
        yield from function(batches)
        release_memory()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
