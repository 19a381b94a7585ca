"""Tables that change together and all at once.

Files are only ever added: a run writes whole folders of its own generation, and in the end one small commit file that
says, for each table and week, which generation counts. Readers go by the last commit, so that a run that fails in
between, or is still going on, changes nothing that they see.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fieldtrail.sources.tables import stored_weeks, write_table, write_weeks

#: Commits that stay readable, for readers that began before the last one.
COMMITS_KEPT = 2


@dataclass(frozen=True)
class Table:
    """Which generation holds each week of a table; the whole of a table without weeks is under the empty name."""

    schema: str
    week: str | None
    folders: Mapping[str, str]

    def before(self, cut: date) -> dict[str, str]:
        return {w: g for w, g in self.folders.items() if date.fromisoformat(w) < cut}


@dataclass(frozen=True)
class Commit:
    number: int = 0
    tables: Mapping[str, Table] = field(default_factory=dict)
    notes: Mapping[str, str] = field(default_factory=dict)

    def weeks(self, name: str) -> list[date]:
        return sorted(map(date.fromisoformat, self.tables[name].folders)) if name in self.tables else []


class Store:
    """The tables below a folder. One run writes at a time: of two, the second to commit fails."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._system = self._fs.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> dict[str, int]:
        """Names in a folder and when they were last changed (seconds)."""
        path = self._fs.Path(folder)
        if not self._system.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() // 1000 for s in self._system.listStatus(path)}

    def _commits(self) -> list[int]:
        names = self._names(f"{self.root}/_commits")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _read_commit(self, number: int) -> Commit:
        text = self.spark.read.text(f"{self.root}/_commits/{number:08d}.json", wholetext=True).first()[0]
        found = json.loads(text)
        return Commit(number, {name: Table(**t) for name, t in found["tables"].items()}, found["notes"])

    def current(self) -> Commit:
        """The last commit; one without tables before the first."""
        numbers = self._commits()
        return self._read_commit(numbers[-1]) if numbers else Commit()

    def write(self, df: DataFrame, name: str, week: str | None = None) -> Table:
        """Write ``df`` as a generation that nothing refers to yet."""
        generation = uuid.uuid4().hex
        path = f"{self.root}/{name}/generation={generation}"
        if week is None:
            write_table(df, path)
            folders = {"": generation}
        else:
            write_weeks(df, path, week)
            folders = {w.isoformat(): generation for w in stored_weeks(self.spark, path, week)}
        return Table(df.schema.json(), week, folders)

    def read(self, table: Table, name: str, since: date | None = None, until: date | None = None) -> DataFrame:
        """A table, or its weeks from ``since`` on and before ``until``: other folders are not even listed."""
        schema = T.StructType.fromJson(json.loads(table.schema))
        folders = []
        for week, generation in sorted(table.folders.items()):
            if week and ((since and date.fromisoformat(week) < since) or (until and date.fromisoformat(week) >= until)):
                continue
            folders.append(f"{self.root}/{name}/generation={generation}" + (f"/{table.week}={week}" if week else ""))
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*folders)
        return rows.select(*schema.names)

    def commit(self, before: Commit, tables: Mapping[str, Table], notes: Mapping[str, str] | None = None) -> Commit:
        """Let ``tables`` count from now on, all at once; fails if another commit has come after ``before``."""
        after = Commit(before.number + 1, {**before.tables, **tables}, {**before.notes, **(notes or {})})
        text = json.dumps({"tables": {n: vars(t) for n, t in after.tables.items()}, "notes": after.notes})
        draft = self._fs.Path(f"{self.root}/_commits/{uuid.uuid4().hex}.draft")
        stream = self._system.create(draft, True)
        stream.write(text.encode())
        stream.close()
        # Unlike a file system's own renaming, this one never replaces a file.
        context = self._fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(self._fs, "Options$Rename"), 0)
        context.rename(self._system.makeQualified(draft), self._system.makeQualified(self._fs.Path(f"{self.root}/_commits/{after.number:08d}.json")), options)
        return after

    def clean(self, orphans_after_hours: float = 24.0) -> None:
        """Remove what only older commits refer to, and generations that failed runs have left behind for some time."""
        numbers = self._commits()
        if not numbers:
            return
        kept = [self._read_commit(n) for n in numbers[-COMMITS_KEPT:]]
        for name in kept[-1].tables:
            live = {g for c in kept if name in c.tables for g in c.tables[name].folders.values()}
            old = {g for n in numbers[:-COMMITS_KEPT] for c in [self._read_commit(n)] if name in c.tables for g in c.tables[name].folders.values()}
            for folder, changed in self._names(f"{self.root}/{name}").items():
                generation = folder.partition("=")[2]
                abandoned = time.time() - changed > 3600 * orphans_after_hours
                if generation and generation not in live and (generation in old or abandoned):
                    self._system.delete(self._fs.Path(f"{self.root}/{name}/{folder}"), True)
        for number in numbers[:-COMMITS_KEPT]:
            self._system.delete(self._fs.Path(f"{self.root}/_commits/{number:08d}.json"), False)
