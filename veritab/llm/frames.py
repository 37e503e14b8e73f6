"""What the operators of this subpackage share: tables, Arrow batches, and intermediate tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: White space that separates words: space and U+0009 to U+000D.  bytes.split() splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows in one Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.  A local one is made only where none is set and Spark is local."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jvm_dir.isDefined():
        return jvm_dir.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="veritab-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: it is worked out once, and a lost executor costs no more than a reread."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow with batches of BATCH_ROWS rows.  The size is a setting of the session, which is read when a job runs, so
    it stays set."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(work, schema)


_held: dict[str, object] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps between tasks under a name: one thing at a time, so that operators that follow each
    other in a worker do not add up."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; ids that are null count as -1, so they are never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts, F.lit(-1))


def texts_of(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def strings_of(column: pa.Array) -> list[str]:
    """A string column as text; null is empty."""
    return [t or "" for t in column.to_pylist()]
