"""Shared plumbing: table access, shared scratch space, code shipping."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SHIPPED: set[str] = set()
#: Rows of one Arrow batch, unless the session says otherwise: batches of whole texts are held several times over.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python workers can import it.

    A session that has Spark's own number of rows in an Arrow batch gets BATCH_ROWS: 10,000 texts take too much memory.
    """
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="voxloom-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "voxloom_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path("voxloom") / p.relative_to(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


#: What this Python worker keeps from task to task, by name.
_HELD: dict[object, object] = {}


def held(name: object, make: Callable[[], object]) -> object:
    """What a worker keeps under a name. Only one thing is kept, as workers go on from one operator to the next."""
    if name not in _HELD:
        let_go()
        _HELD[name] = make()
    return _HELD[name]


def let_go() -> None:
    """Drops what this worker keeps and gives freed memory back to the system, which allocators otherwise hold on to."""
    _HELD.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors see.

    It is ``spark.checkpoint.dir`` where that is set. Where it is unset, a local master gets a temporary
    folder of its own; a cluster raises, because no machine-local folder would do.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="voxloom-shared-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        base = f"file://{base}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/voxloom-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives the loss of executors.

    free: the write's shuffle files go with its end; else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(_CLEANUP_CONF, None)
    if free:
        spark.conf.set(_CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        if free and before is None:
            spark.conf.unset(_CLEANUP_CONF)
        elif free:
            spark.conf.set(_CLEANUP_CONF, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a materialised table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(df._scratch)
    p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def named(name: str) -> Column:
    """A column by its exact name, whatever signs are in it."""
    return F.col(f"`{name.replace('`', '``')}`")


def as_row(docs: DataFrame) -> Column:
    """All columns as one struct ``row``, whatever their names."""
    return F.struct(*(named(c) for c in docs.columns)).alias("row")


def row_schema(docs: DataFrame, more: str) -> T.StructType:
    """``row`` with the columns of docs, then the fields of ``more``."""
    return T.StructType([T.StructField("row", T.StructType(docs.schema.fields)), *T._parse_datatype_string(more).fields])


def part_of(batch: pa.RecordBatch, at: int) -> pa.Array:
    """Field number ``at`` of the ``row`` column of a batch."""
    return pc.struct_field(batch.column("row"), [at])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_small(big: DataFrame, small: DataFrame, on: str | list[str], how: str, rows: int, limit: int = 1_000_000) -> DataFrame:
    """Broadcast ``small`` only where its counted ``rows`` stay under ``limit``; otherwise a shuffled join."""
    return big.join(F.broadcast(small) if rows <= limit else small.hint("merge"), on, how)


def sample_rows(rows: DataFrame, key: str, size: int) -> DataFrame:
    """About ``size`` rows, those with the smallest hashed key; only keys are read to find them."""
    h = F.xxhash64(key)
    least = [r[0] for r in rows.select(h.alias("h")).orderBy("h").limit(size).collect()]
    return rows.where(h <= (least[-1] if least else 0))


def sample_texts(rows: DataFrame, key: str, text: str, size: int, longest: int) -> list[str]:
    """Texts of at most ``longest`` bytes of about ``size`` sampled rows, in order of hashed key; ``size`` at most."""
    found = sample_rows(rows, key, size).where(F.octet_length(text) <= longest).select(F.xxhash64(key).alias("h"), F.col(text).alias("t")).limit(size).collect()
    return [r.t for r in sorted(found, key=lambda r: (r.h, r.t))]
