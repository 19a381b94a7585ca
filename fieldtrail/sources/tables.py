"""Writing and reading result tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class LazyTables(Mapping):
    """Tables by name, each made on first use, so that a plan for one costs one."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def __contains__(self, name: object) -> bool:
        return name in self._makers


def write_weeks(df: DataFrame, path: str, week: str, *, whole: bool = True) -> None:
    """Write a table by week: the whole table, or only the weeks present in ``df``, the others staying.

    The rebalance hint gathers a week in few files and lets adaptive execution
    split a week that is too large for one task.
    """
    (
        df.hint("rebalance", week)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(week)
        .parquet(path)
    )


def stored_weeks(spark: SparkSession, path: str, week: str) -> list[date]:
    """The weeks a table has, from the names of its folders; no file is opened."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    names = [status.getPath().getName() for status in system.listStatus(root) if status.isDirectory()]
    values = [n.partition("=")[2] for n in names if n.startswith(f"{week}=")]
    return sorted(date.fromisoformat(v) for v in values if v != "__HIVE_DEFAULT_PARTITION__")


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first build."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_written(df: DataFrame, path: str) -> DataFrame:
    """What was written of ``df`` to ``path``; also if that has no files, as a table by week without rows."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder in the one that the session's driver and executors share (``spark.checkpoint.dir``)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{base.rstrip('/')}/fieldtrail/{purpose}-{uuid.uuid4().hex}"
