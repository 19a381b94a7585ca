"""Near-duplicates by SimHash, with fingerprints searched through vantage-point trees.

Equal fingerprints become one first. A tree over a bounded sample splits the space of fingerprints: a node has a vantage
point and a radius; fingerprints within the radius go in, the others out. Leaves are shards. A fingerprint lives in one
leaf, and it visits each other leaf that the triangle inequality cannot rule out, in one direction of each boundary
only, so that no pair is looked at twice. A task splits its shard further in the same way, compares what is left bit by
bit, and returns a spanning forest of the links it found, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import keep, portions, release

#: Fingerprints of the sample that the tree is built from, at most.
SAMPLE = 1 << 16
#: Leaves, at most; the tree is sent to all tasks. Their number follows the square root of that of the fingerprints:
#: more leaves would mean more visits to shuffle, and tasks go on splitting in memory.
MOST_LEAVES = 4096
#: Fingerprints below which a task does not split any more, and beyond which one task does not take a leaf alone.
LEAF, TASK = 2048, 250_000

# For each byte, its bits as eight counters of a byte each.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]


def shingle_hashes(text: str | None, width: int) -> list[int]:
    """XXH64 (seed 42) of each run of ``width`` words; of all words if there are fewer; of nothing if there are none."""
    words = (text or "").encode().lower().split()
    if not words:
        return []
    joined = zip(*(words[i:] for i in range(width))) if len(words) > width else [words]
    return [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in joined]


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each run of ``sizes`` hashes, the bits set in over half of them."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    ends = np.cumsum(sizes[full])
    starts = ends - sizes[full]
    # Counters of a byte hold 255; runs are cut there and added up afterwards.
    cuts = np.concatenate([np.arange(s, e, 255) for s, e in zip(starts, ends)])
    spread = _SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    counts = np.add.reduceat(spread, cuts, axis=0).view(np.uint8).reshape(len(cuts), 64)
    totals = np.add.reduceat(counts.astype(np.int64), np.searchsorted(cuts, starts), axis=0)
    bits = (2 * totals > sizes[full, None]).astype(np.uint8)
    out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def prints_of(texts: pa.Array, width: int) -> np.ndarray:
    """The fingerprint of each text."""
    prints = []
    for rows in portions(texts, 250_000):  # their hashes and counters take some tens of times the room of texts
        hashes = [np.array(shingle_hashes(t, width), dtype=np.uint64) for t in rows]
        sizes = np.array([len(h) for h in hashes], dtype=np.int64)
        flat = np.concatenate([np.zeros(0, dtype=np.uint64), *hashes])
        prints.append(majority_bits(flat, sizes))
    return np.concatenate(prints)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp_ (64 bits) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = prints_of(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp_"])
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp_ long")


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _split(points: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """A vantage point and radius with as few points near the boundary as a few tries find; None if all are close."""
    best, choice = None, None
    for v in rng.choice(points, min(8, len(points)), replace=False):
        d = distance(points, v)
        r = int(np.median(d))
        r -= bool((d <= r).all())  # something must be outside
        inside = int((d <= r).sum())
        if not 0 < inside < len(points):
            continue
        lopsided = abs(2 * inside - len(points)) / len(points)
        cost = float((abs(d.astype(int) - r) <= 3).mean()) + lopsided
        if best is None or cost < best:
            best, choice = cost, (np.uint64(v), r)
    return choice


class Tree:
    """Arrays of a vantage-point tree: per node its point, radius, and children (a leaf is written as -1 - leaf)."""

    def __init__(self, sample: np.ndarray, leaves: int) -> None:
        self.points: list[np.uint64] = []
        self.radii: list[int] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        sample = np.unique(sample)
        self.root = self._grow(sample, max(16, len(sample) // max(1, leaves)), np.random.default_rng(0))

    def _grow(self, points: np.ndarray, enough: int, rng: np.random.Generator) -> int:
        choice = _split(points, rng) if len(points) > enough and self.leaves < MOST_LEAVES else None
        if choice is None:
            self.leaves += 1
            return -self.leaves
        node = len(self.points)
        self.points.append(choice[0])
        self.radii.append(choice[1])
        self.children.append([0, 0])
        inside = distance(points, choice[0]) <= choice[1]
        self.children[node] = [self._grow(points[inside], enough, rng), self._grow(points[~inside], enough, rng)]
        return node

    def route(self, fps: np.ndarray, radius: int, visits: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per leaf, the fingerprints that live there and (if asked for) those that visit."""
        todo = [(self.root, fps, fps[:0])]
        while todo:
            node, home, visit = todo.pop()
            if not len(home) and not len(visit):
                continue
            if node < 0:
                yield -1 - node, home, visit
                continue
            v, r = self.points[node], self.radii[node]
            inner, outer = self.children[node]
            (home_in, home_out), (visit_in, visit_out) = divided(home, visit, v, r, radius, visits)
            todo += [(inner, home_in, visit_in), (outer, home_out, visit_out)]


def divided(home: np.ndarray, visit: np.ndarray, v: np.uint64, r: int, radius: int, visits: bool = True):
    """What lives on either side of a boundary, and what visits: from outside come those within ``radius`` of it."""
    d = distance(home, v)
    inside = d <= r
    if not visits:
        return (home[inside], home[~inside]), (visit, visit)
    e = distance(visit, v)
    near = home[~inside & (d <= r + radius)]
    return (home[inside], home[~inside]), (np.concatenate([visit[e <= r + radius], near]), visit[e.astype(int) > r - radius])


class _Forest:
    """Union of numbered nodes, in bulk."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def near_links(home: np.ndarray, visit: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within ``home`` and between ``home`` and ``visit``, as two columns."""
    values = np.unique(np.concatenate([home, visit]))
    forest, rng = _Forest(len(values)), np.random.default_rng(1)
    todo = [(np.unique(home), np.setdiff1d(visit, home))]
    while todo:
        own, others = todo.pop()
        choice = _split(own, rng) if len(own) > LEAF else None
        if choice is not None:
            (own_in, own_out), (in_, out) = divided(own, others, *choice, radius)
            # A boundary that nearly all have to cross only costs.
            if len(in_) + len(out) + len(own) < 1.7 * (len(own) + len(others)):
                todo += [(own_in, in_), (own_out, out)]
                continue
        against = np.concatenate([own, others])
        step = max(1, (1 << 20) // max(1, len(against)))
        at = np.searchsorted(values, against)
        for i in range(0, len(own), step):
            rows, cols = np.nonzero(distance(own[i : i + step, None], against[None, i:]) <= radius)
            forest.join(at[rows + i], at[cols + i])
    linked = np.flatnonzero(forest.root != np.arange(len(values)))
    return values[linked], values[forest.root[linked]]


def fingerprint_links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """a_, b_: links that join all of the distinct fingerprints fp_ that are within ``radius`` bits of one another."""
    spark = prints.sparkSession
    count = prints.count()
    leaves = min(MOST_LEAVES, max(1, round(count**0.5 / 4)))
    # Hash order makes the sample a random one; it is a sixteenth of the rows at most.
    sample = prints.orderBy(F.xxhash64("fp_")).limit(min(SAMPLE, count // 16 + 1)).toPandas()["fp_"].to_numpy(np.int64)
    tree = spark.sparkContext.broadcast(Tree(sample.view(np.uint64), leaves))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            found = [(leaf, len(home)) for leaf, home, _ in tree.value.route(fps, radius, False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.int64())], ["leaf_", "n_"]
            )

    # One row per leaf, of which there are MOST_LEAVES at most.
    counts = prints.select("fp_").mapInArrow(homes, "leaf_ int, n_ long").groupBy("leaf_").agg(F.sum("n_").alias("n_"))
    parts = {r["leaf_"]: -(-r["n_"] // TASK) for r in counts.collect() if r["n_"] > TASK}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for leaf, home, visit in tree.value.route(fps, radius, True):
                for part in range(n := parts.get(leaf, 1)):
                    # In a divided leaf, what lives in a part visits the parts before it.
                    of = (home % np.uint64(n)).astype(int)
                    rows = [(home[of == part], True), (np.concatenate([visit, home[of > part]]), False)]
                    for values, is_home in rows:
                        k = len(values)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(k, leaf, dtype=np.int32)),
                                pa.array(np.full(k, part, dtype=np.int32)),
                                pa.array(np.full(k, is_home)),
                                pa.array(values.view(np.int64)),
                            ],
                            ["leaf_", "part_", "home_", "fp_"],
                        )

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        fps, home = rows["fp_"].to_numpy().view(np.uint64), rows["home_"].to_numpy()
        a, b = near_links(fps[home], fps[~home], radius)
        return pd.DataFrame({"a_": a.view(np.int64), "b_": b.view(np.int64)})

    dealt = prints.select("fp_").mapInArrow(deal, "leaf_ int, part_ int, home_ boolean, fp_ long")
    return dealt.groupBy("leaf_", "part_").applyInPandas(links, "a_ long, b_ long")


def firsts(rows: DataFrame, first, radius: int) -> DataFrame:
    """fp_ and first_: for each fingerprint of ``rows``, the smallest ``first`` (a column of ``rows``) in its group."""
    prints = keep(rows.groupBy("fp_").agg(F.min(first).alias("least_")))
    linked = components(fingerprint_links(prints, radius))
    root = F.coalesce("component_", "fp_").alias("root_")
    named = keep(prints.join(linked.withColumnRenamed("node_", "fp_"), "fp_", "left").select("fp_", "least_", root))
    groups = named.groupBy("root_").agg(F.min("least_").alias("first_"))
    return named.join(groups, "root_").select("fp_", "first_")


def near_groups(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id linked, itself included).

    Documents link if their fingerprints differ in ``radius`` bits at most; groups follow links. A null or blank text
    has fingerprint zero and links like any other. A null doc_id is in its group but never names it, unless all are
    null. Repeated rows each give a row. An empty table gives no rows. Other columns are ignored. Texts of any length
    are read whole; a task holds the hashes of one text, or of texts of 250,000 characters, at once.
    """
    rows = keep(fingerprints(docs, width))
    return rows.join(firsts(rows, F.col("doc_id"), radius), "fp_").select(
        "doc_id", F.lower(F.lpad(F.hex("fp_"), 16, "0")).alias("fingerprint"), F.col("first_").alias("component_id")
    )


def one_of_each_group(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of ``near_groups``: that of the smallest doc_id, with all its columns.

    Of rows that share that doc_id, one stays; a null doc_id comes last. Rows are numbered and written once together
    with their fingerprints, so only numbers are joined with the texts: those of the rows that go, which are mostly few.
    An empty table gives no rows.
    """

    @F.arrow_udf("long")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(prints_of(texts, width).view(np.int64))
        release()

    # All columns in one, so that none of their names can clash.
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc_")
    rows = keep(docs.select(whole, fingerprint(F.col("text")).alias("fp_"), F.monotonically_increasing_id().alias("row_")))
    id_ = F.col("doc_.doc_id").cast("long")
    chosen = firsts(rows, F.struct(id_.isNull().alias("no_id"), id_.alias("id"), F.col("row_").alias("row")), radius)
    stays = chosen.select(F.col("first_.row").alias("row_")).distinct()
    gone = keep(rows.select("row_").join(stays, "row_", "left_anti"))
    return rows.join(gone, "row_", "left_anti").select("doc_.*")
