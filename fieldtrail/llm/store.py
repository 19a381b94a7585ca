"""Tables that cut lineage: written as Parquet to the folder that all executors share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The white space that words, lines and equality of texts mean here.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the folder its context was given. There is no other default."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def keep(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once and read back: later stages and lost executors read them, not their origin."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_path = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``keep`` made and that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.kept_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: What a step remembers in a Python process from task to task, by name of the step.
REMEMBERED: dict[str, dict] = {}


def release(step: str | None = None) -> None:
    """Give memory that a finished task has freed back to the machine: its Python process stays, for later tasks.

    These may be of any step, so what other steps than ``step`` remember in the process goes too.
    """
    for other in REMEMBERED.keys() - {step}:
        REMEMBERED[other].clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def portions(texts: pa.Array, chars: int = 1_000_000) -> Iterator[list[str | None]]:
    """The texts of a column, a bounded number of characters (or one text) at once."""
    portion, size = [], 0
    for text in texts:
        portion.append(text.as_py())
        size += len(portion[-1] or "")
        if size >= chars:
            yield portion
            portion, size = [], 0
    yield portion


def slices(batch: pa.RecordBatch, column: int, size: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """A batch in parts, without copies: the texts of ``column`` in a part have ``size`` bytes at most, or it is one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def words(text):
    """How many runs of other than white space a text column has; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def some_of_each(rows: DataFrame, group: str, keys: list[str], most: int) -> DataFrame:
    """Up to ``most`` rows of each value of ``group``, the first by a hash of ``keys`` (then by ``keys``).

    Hashes are counted in 4,096 bands first, so that only rows up to the band in which a group is complete are ranked.
    """
    hashed = rows.withColumn("hash_", F.xxhash64(*keys))
    # Bands in the order of the hash: its upper twelve bits, as a signed number.
    hashed = hashed.withColumn("band_", F.shiftright("hash_", 52))
    counts = hashed.groupBy(group, "band_").agg(F.count("*").alias("n_"))
    before = F.sum("n_").over(Window.partitionBy(group).orderBy("band_")) - F.col("n_")
    last = counts.withColumn("before_", before).where(F.col("before_") < most).groupBy(group).agg(F.max("band_").alias("last_"))
    near = hashed.join(last, group).where("band_ <= last_")
    order = Window.partitionBy(group).orderBy("hash_", *keys)
    ranked = near.withColumn("rank_", F.row_number().over(order)).where(F.col("rank_") <= most)
    return ranked.select(*rows.columns)
