"""Line dedup by a sharded minimal perfect hash.

Lines are hashed where the documents are (128 bits: half finds the place, half is the fingerprint), counted in one
aggregation that combines before its shuffle, and those in enough documents go into the index: per shard a minimal
perfect hash over line hashes, and arrays of fingerprints, counts and the document that keeps the line. Documents then
probe the arrays. The arrays are sent to all executors while they are within ``broadcast_bytes``, and no text is
shuffled; a larger index stays in its shards, and the hashes of lines go to them, with busy shards split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .mph import Shard
from .store import SPACE_CHARS, keep, release, slices

#: The id that null counts as: smaller than any other.
NO_ID = -(2**63)


def _key(line: str, min_chars: int) -> bytes | None:
    """The hash of a line's key, or None if the line is too short to count."""
    key = line.strip(SPACE_CHARS)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """hash_, print_, doc_: each distinct line of each document that is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            digests, sizes = [], []
            for text in batch.column(1).to_pylist():
                own = {_key(line, min_chars) for line in (text or "").split("\n")} - {None}
                digests += own
                sizes.append(len(own))
            hash_, print_ = _halves(digests)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(hash_), pa.array(print_), pa.array(ids)], ["hash_", "print_", "doc_"])
        release()

    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(ids.alias("doc_"), "text").mapInArrow(run, "hash_ long, print_ long, doc_ long")


def line_index(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, shard_keys: int = 1 << 17) -> DataFrame:
    """One row per shard: shard_, blob_, with all lines of at least ``min_chars`` that ``min_docs`` documents hold."""
    counted = (
        line_hashes(docs, min_chars)
        .groupBy("hash_", "print_")
        .agg(F.count("*").alias("count_"), F.max("doc_").alias("keeper_"))
        .where(F.col("count_") >= min_docs)
    )
    counted = keep(counted)
    shards = 1 << max(0, (counted.count() // shard_keys).bit_length())

    def build(lines: pd.DataFrame) -> pd.DataFrame:
        # Two lines with one half in common cannot share a place; 2**64 places make this a case for completeness only.
        lines = lines.sort_values(["hash_", "print_"])
        same = lines["hash_"].duplicated()
        made = []
        while len(lines):
            now = lines[~same]
            shard = Shard.build(
                now["hash_"].to_numpy().view(np.uint64),
                now["print_"].to_numpy(),
                {"count": now["count_"].to_numpy(), "keeper": now["keeper_"].to_numpy()},
            )
            made.append(shard.to_bytes())
            lines = lines[same]
            same = lines["hash_"].duplicated()
        return pd.DataFrame({"shard_": [int(now["shard_"].iloc[0])] * len(made), "blob_": made})

    shard = F.col("hash_").bitwiseAND(F.lit(shards - 1)).cast("int")
    built = counted.withColumn("shard_", shard).groupBy("shard_").applyInPandas(build, "shard_ int, blob_ binary")
    return keep(built.withColumn("shards_", F.lit(shards)))


class _Index:
    """The shards in a task; read from bytes on first use."""

    def __init__(self, shards: int, blobs: list[tuple[int, bytes]]) -> None:
        self.shards, self.blobs, self.open = shards, blobs, None

    def keepers(self, hash_: np.ndarray, print_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each line is in the index, and the document that keeps it."""
        if self.open is None:
            self.open = [(n, Shard.from_bytes(b)) for n, b in self.blobs]
        found, keeper = np.zeros(len(hash_), dtype=bool), np.zeros(len(hash_), dtype=np.int64)
        home = hash_ & (self.shards - 1)
        for number, shard in self.open:
            mine = np.flatnonzero(home == number)
            at = shard.lookup(hash_[mine].view(np.uint64), print_[mine])
            mine, at = mine[at >= 0], at[at >= 0]
            found[mine], keeper[mine] = True, shard.values["keeper"][at]
        return found, keeper


def _rewritten(text: str, drop: set[int] | np.ndarray) -> tuple[str, int, int]:
    """The text without the lines of these numbers, how many lines it had, how many went."""
    lines = text.split("\n")
    left = [line for i, line in enumerate(lines) if i not in drop] if len(drop) else lines
    return "\n".join(left), len(lines), len(lines) - len(left)


_RESULT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "n_lines", "n_dropped")]
    + [T.StructField(n, T.StringType()) for n in ("kept_sha256", "text")]
)


def _results(ids: list, texts: list[str | None], drops: list[set[int]], carried: pa.Array) -> pa.RecordBatch:
    made = [_rewritten(t or "", d) for t, d in zip(texts, drops)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([m[1] for m in made], pa.int64()),
            pa.array([m[2] for m in made], pa.int64()),
            pa.array([hashlib.sha256(m[0].encode()).hexdigest() for m in made], pa.string()),
            # A null text stays null.
            pa.array([None if t is None else m[0] for t, m in zip(texts, made)], pa.string()),
            carried,
        ],
        [*_RESULT.names, "carried_"],
    )


def _result_type(docs: DataFrame) -> T.StructType:
    return T.StructType([*_RESULT.fields, docs.schema["carried_"]])


def _probe_in_place(docs: DataFrame, index: DataFrame, min_chars: int) -> DataFrame:
    """Every task has all arrays and probes them for its own documents."""
    rows = index.collect()
    sent = docs.sparkSession.sparkContext.broadcast(
        _Index(rows[0]["shards_"] if rows else 1, [(r["shard_"], bytes(r["blob_"])) for r in rows])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at, digests = [], []
            for i, text in enumerate(texts):
                for k, line in enumerate((text or "").split("\n")):
                    if (key := _key(line, min_chars)) is not None:
                        at.append((i, k))
                        digests.append(key)
            found, keeper = sent.value.keepers(*_halves(digests))
            drops: list[set[int]] = [set() for _ in texts]
            for j in np.flatnonzero(found):
                i, k = at[j]
                if keeper[j] != (NO_ID if ids[i] is None else ids[i]):
                    drops[i].add(k)
            yield _results(ids, texts, drops, batch.column(2))
        release()

    return docs.mapInArrow(run, _result_type(docs))


def _probe_at_shards(docs: DataFrame, index: DataFrame, min_chars: int, task_rows: int) -> DataFrame:
    """Hashes of lines go to the shards; a shard that gets more than ``task_rows`` of them is there several times."""
    stored = keep(docs.withColumn("row_", F.monotonically_increasing_id()))
    shards = index.select(F.coalesce(F.max("shards_"), F.lit(1))).first()[0]

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            rows, numbers, ids, digests = [], [], [], []
            for row, id_, text in zip(*(c.to_pylist() for c in batch.columns)):
                for k, line in enumerate((text or "").split("\n")):
                    if (key := _key(line, min_chars)) is not None:
                        rows.append(row)
                        numbers.append(k)
                        ids.append(id_)
                        digests.append(key)
            hash_, print_ = _halves(digests)
            arrays = [pa.array(rows, pa.int64()), pa.array(numbers, pa.int32()), pa.array(ids, pa.int64())]
            arrays += [pa.array(hash_), pa.array(print_), pa.array((hash_ & (shards - 1)).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["row_", "line_", "doc_", "hash_", "print_", "shard_"])
        release()

    ids = F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_")
    schema = "row_ long, line_ int, doc_ long, hash_ long, print_ long, shard_ int"
    probes = stored.select("row_", ids, "text").mapInArrow(hashes, schema)
    parts = probes.groupBy("shard_").agg(F.ceil(F.count("*") / F.lit(task_rows)).cast("int").alias("parts_"))
    parts = keep(parts)
    # The second reading has columns of its own, so that the two sides can meet again.
    again = parts.select(F.col("shard_").alias("shard_"), F.col("parts_").alias("parts_"))
    arrays = index.join(again, "shard_").withColumn("part_", F.explode(F.sequence(F.lit(0), F.col("parts_") - 1)))
    dealt = probes.join(parts, "shard_").withColumn("part_", F.pmod(F.hash("row_", "line_"), "parts_").cast("int"))

    def probe(lines: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found, keeper = _Index(1, [(0, bytes(b)) for b in own["blob_"]]).keepers(
            lines["hash_"].to_numpy(), lines["print_"].to_numpy()
        ) if len(own) and len(lines) else (np.zeros(len(lines), dtype=bool), np.zeros(len(lines), dtype=np.int64))
        return lines.loc[found & (keeper != lines["doc_"].to_numpy()), ["row_", "line_"]]

    drops = (
        dealt.groupBy("shard_", "part_")
        .cogroup(arrays.groupBy("shard_", "part_"))
        .applyInPandas(probe, "row_ long, line_ int")
        .groupBy("row_")
        .agg(F.collect_list("line_").alias("drop_"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            ids, texts, drops_ = (batch.column(k).to_pylist() for k in (0, 1, 3))
            yield _results(ids, texts, [set(d or ()) for d in drops_], batch.column(2))
        release()

    joined = stored.join(drops, "row_", "left").select("doc_id", "text", "carried_", "drop_")
    return joined.mapInArrow(run, _result_type(docs))


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 3,
    min_chars: int = 20,
    carry: tuple[str, ...] = (),
    broadcast_bytes: int = 64 << 20,
    task_rows: int = 500_000,
    shard_keys: int = 1 << 17,
) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256, text (what stays), carried_ (the columns ``carry``).

    A line's key is the line without white space at its ends, A-Z in lower case. Lines whose key has ``min_chars`` code
    points and is in ``min_docs`` documents go, except from the largest doc_id that holds it. Every row counts as a
    document; rows that repeat a doc_id keep the line together, and a null doc_id is smaller than all others. A null or
    empty text is one empty line (a null stays null). An empty table gives no rows. Other columns are ignored.
    """
    carried = F.struct(*carry) if carry else F.lit(None).cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", carried.alias("carried_"))
    index = line_index(docs, min_docs, min_chars, shard_keys)
    size = index.agg(F.sum(F.length("blob_"))).first()[0] or 0
    if size <= broadcast_bytes:
        return _probe_in_place(docs, index, min_chars)
    return _probe_at_shards(docs, index, min_chars, task_rows)


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in its own columns, each with the text (and n_chars, if there) that stays."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    made = dedup_lines(docs, carry=rest, **options)
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return made.select(*(new[c].alias(c) if c in new else F.col("carried_").getField(c).alias(c) for c in docs.columns))
