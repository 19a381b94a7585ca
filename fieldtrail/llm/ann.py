"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

Equal vectors become one node first. A first graph comes from lists around sampled pivots. Then rounds of NN-descent: each
node brings its neighbours, and the nodes whose neighbour it is, together, as neighbours of a neighbour, and each of them
keeps the nearest it has met; pairs that have met before are left out. Rounds end when few edges change. Queries start at
their own node and at the nearest pivots and walk along edges in both directions: the nearest nodes not visited yet are
joined with the graph, until none of the nearest is left to visit. Edges are pairs of ids; vectors are joined where
distances are needed. All of it uses the original numbers, in 4 bytes if that loses nothing, as rounded ones tell
near-copies apart only by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import discard, keep

#: Neighbours of a node, and nodes whose neighbour it is that it brings together with them, at most.
NEIGHBOURS, REVERSE = 20, 20
#: Rounds end when a smaller share of edges is new, or after so many.
CHANGED, ROUNDS = 0.02, 12
#: Nearest nodes that a query keeps on its walk; steps of it, at most; pivots where it starts.
BEAM, STEPS, STARTS = 256, 40, 8
#: Pivots at most (a bounded sample), nodes for each of them at best, lists a node is in, and nodes of a list that one
#: task compares. A longer list is dealt into several, each list in a way of its own, so that its parts meet elsewhere.
PIVOTS, PER_PIVOT, LISTS, LIST_ROWS = 2048, 128, 8, 1024
#: Of the neighbours in one list, or of those proposed by one node, how many go on.
FROM_LIST, PROPOSED = 12, 5


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector_ (doubles) of the rows that take part, each once.

    Null ids, null, empty or zero vectors, and vectors with null or non-finite components take no part. Vectors of
    differing lengths are compared as if the shorter ones went on with zeros.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector_")).where(
        F.col("vec_id").isNotNull() & F.col("vector_").isNotNull()
    )
    finite = F.forall("vector_", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("vector_", lambda x: x != 0))
    longest = rows.agg(F.max(F.size("vector_"))).first()[0] or 0
    zeros = F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("vector_"))
    return rows.withColumn("vector_", F.concat("vector_", zeros)).dropDuplicates(["vec_id", "vector_"])


def packed(vectors: np.ndarray, wide: bool) -> list[bytes]:
    """Each vector as the size of a number (4 bytes) and its numbers, of 8 bytes if ``wide``, else of 4."""
    numbers = np.ascontiguousarray(vectors, dtype="<f8" if wide else "<f4").view(np.int8)
    size = np.full((len(vectors), 1), 8 if wide else 4, dtype="<i4").view(np.int8)
    return [row.tobytes() for row in np.concatenate([size, numbers], axis=1)]


def unpacked(column: pa.Array) -> np.ndarray:
    """The vectors of a column of ``packed`` ones."""
    values = column.to_pylist()
    if not values:
        return np.zeros((0, 1))
    raw = np.frombuffer(b"".join(values), dtype=np.int8).reshape(len(values), -1)
    return raw[:, 4:].copy().view(f"<f{raw[0, 0]}").astype(np.float64)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all of ``a`` and all of ``b``, in each block of the leading dimensions."""
    aa, bb = (a * a).sum(-1), (b * b).sum(-1)
    return np.maximum(aa[..., :, None] + bb[..., None, :] - 2 * a @ np.swapaxes(b, -1, -2), 0)


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names.split())


def nodes_of(vectors: DataFrame) -> DataFrame:
    """node_ (smallest id of equal vectors), vector_, small_ (packed), members_ (the smallest ids, as many as answers
    can need), of ``usable`` vectors. Of a vector that many rows share, only these ids are shuffled."""
    order = Window.partitionBy("vector_").orderBy("vec_id")
    few = vectors.withColumn("rank_", F.row_number().over(order)).where(F.col("rank_") <= NEIGHBOURS)
    exact = F.forall("vector_", lambda x: x.cast("float").cast("double") == x)
    wide = not vectors.where(~exact).isEmpty()
    grouped = few.groupBy("vector_").agg(F.min("vec_id").alias("node_"), F.sort_array(F.collect_set("vec_id")).alias("members_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column(0).to_pylist(), dtype=np.float64)
            small = packed(rows, wide) if len(rows) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(small, pa.binary())], [*batch.schema.names, "small_"])

    return grouped.mapInArrow(run, "vector_ array<double>, node_ long, members_ array<long>, small_ binary")


def _nearest(pairs: DataFrame, count: int) -> DataFrame:
    """The ``count`` nearest of each node_, from rows of node_, other_, far_."""
    once = pairs.groupBy("node_", "other_").agg(F.min("far_").alias("far_"))
    order = Window.partitionBy("node_").orderBy("far_", "other_")
    return once.withColumn("rank_", F.row_number().over(order)).where(F.col("rank_") <= count).drop("rank_")


class Pivots:
    """A bounded sample of nodes and their vectors, by the hash of their ids."""

    def __init__(self, nodes: DataFrame, count: int) -> None:
        wanted = max(1, min(PIVOTS, count // PER_PIVOT))
        chosen = nodes.orderBy(F.xxhash64("node_")).limit(wanted).select("node_", "small_").collect()
        self.ids = np.array([r["node_"] for r in chosen], dtype=np.int64)
        self.vectors = unpacked(pa.array([bytes(r["small_"]) for r in chosen], pa.binary()))

    def nearest(self, vectors: np.ndarray, most: int) -> np.ndarray:
        """Numbers of the nearest pivots of each vector."""
        found = []
        for k in range(0, len(vectors), 1000):  # a bounded table of distances
            far = _squared(vectors[k : k + 1000], self.vectors)
            found.append(np.argsort(far, axis=1)[:, :most])
        return np.concatenate(found) if found else np.zeros((0, most), dtype=np.int64)


def first_edges(nodes: DataFrame, pivots: Pivots) -> DataFrame:
    """node_, other_, far_ from comparing all nodes of a list; a list has the nodes nearest to a pivot."""
    sent = nodes.sparkSession.sparkContext.broadcast(pivots)
    lists = min(LISTS, len(pivots.ids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            near = sent.value.nearest(unpacked(batch.column(1)), lists)
            at = np.repeat(np.arange(len(batch)), lists)
            yield _batch("list_ node_ small_", pa.array(near.ravel().astype(np.int32)), *(c.take(pa.array(at)) for c in batch.columns))

    dealt = nodes.select("node_", "small_").mapInArrow(assign, "list_ int, node_ long, small_ binary")
    # One row per pivot.
    sizes = {r["list_"]: r["n"] for r in dealt.groupBy("list_").agg(F.count("*").alias("n")).collect()}
    sizes[-1] = 1  # a map needs an entry
    parts = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, -(-n // LIST_ROWS))))
    part = F.pmod(F.xxhash64("list_", "node_"), parts[F.col("list_")]).cast("int")

    def compare(rows: pa.Table) -> pa.Table:
        ids, vectors = rows.column("node_").to_numpy(), unpacked(rows.column("small_").combine_chunks())
        far = _squared(vectors, vectors)
        np.fill_diagonal(far, np.inf)
        k = min(FROM_LIST, len(ids) - 1)
        near = np.argpartition(far, max(k - 1, 0), axis=1)[:, :k]
        return pa.table(
            {
                "node_": np.repeat(ids, k),
                "other_": ids[near].ravel(),
                "far_": np.take_along_axis(far, near, 1).ravel().astype(np.float32),
            }
        )

    grouped = dealt.withColumn("part_", part).groupBy("list_", "part_")
    return _nearest(grouped.applyInArrow(compare, "node_ long, other_ long, far_ float"), NEIGHBOURS)


def both_ways(edges: DataFrame) -> DataFrame:
    """node_, other_, new_: neighbours of each node, and some of the nodes whose neighbour it is, chosen by hash."""
    back = edges.select(F.col("other_").alias("node_"), F.col("node_").alias("other_"), "new_")
    order = Window.partitionBy("node_").orderBy(F.desc("new_"), F.xxhash64("other_", "node_"))
    some = back.withColumn("rank_", F.row_number().over(order)).where(F.col("rank_") <= REVERSE).drop("rank_")
    ways = edges.select("node_", "other_", "new_").unionByName(some)
    return ways.groupBy("node_", "other_").agg(F.max("new_").alias("new_"))


def proposals(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """node_, other_, far_: what the nodes that meet at a node are to one another, the nearest of them, if one of the two
    has come there since the last round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 500):  # with vectors, rows are large
                met = batch.column(0).slice(start, 500)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in met])])
                flat = met.flatten()
                ids, new = flat.field(0).to_numpy(), flat.field(1).to_numpy(zero_copy_only=False)
                vectors = unpacked(flat.field(2))
                out: list[tuple] = [([], [], [])]
                for a, b in zip(ends, ends[1:]):
                    far = _squared(vectors[a:b], vectors[a:b])
                    far[~(new[a:b, None] | new[None, a:b])] = np.inf
                    np.fill_diagonal(far, np.inf)
                    k = min(PROPOSED, b - a - 1)
                    near = np.argpartition(far, k - 1, axis=1)[:, :k]
                    chosen = np.take_along_axis(far, near, 1).ravel()
                    good = np.isfinite(chosen)
                    out.append((np.repeat(ids[a:b], k)[good], ids[a:b][near].ravel()[good], chosen[good]))
                columns = [np.concatenate(c) for c in zip(*out)]
                kinds = (np.int64, np.int64, np.float32)
                yield _batch("node_ other_ far_", *(pa.array(c.astype(t)) for c, t in zip(columns, kinds)))

    others = nodes.select(F.col("node_").alias("other_"), "small_")
    met = both_ways(edges).join(others, "other_").groupBy("node_")
    met = met.agg(F.collect_list(F.struct("other_", "new_", "small_")).alias("met_"))
    met = met.where((F.size("met_") > 1) & F.exists("met_", lambda x: x["new_"]))
    return met.select("met_").mapInArrow(run, "node_ long, other_ long, far_ float")


def neighbour_graph(nodes: DataFrame, pivots: Pivots, rounds: int = ROUNDS) -> DataFrame:
    """node_, other_: edges of both directions after NN-descent over ``nodes`` (kept)."""
    edges = keep(first_edges(nodes, pivots).withColumn("new_", F.lit(True)))
    order = Window.partitionBy("node_").orderBy("far_", "other_")
    for _ in range(rounds):
        met = edges.withColumn("new_", F.lit(False)).unionByName(proposals(edges, nodes).withColumn("new_", F.lit(True)))
        once = met.groupBy("node_", "other_").agg(F.min("far_").alias("far_"), F.min("new_").alias("new_"))
        ranked = once.withColumn("rank_", F.row_number().over(order)).where(F.col("rank_") <= NEIGHBOURS).drop("rank_")
        better = keep(ranked)
        discard(edges)
        edges = better
        count, new = edges.agg(F.count("*"), F.count_if("new_")).first()
        if new < CHANGED * count or not count:
            break
    return keep(both_ways(edges).select("node_", "other_"))


def walk(
    graph: DataFrame, nodes: DataFrame, starts: DataFrame, pivots: Pivots, beam: int = BEAM, steps: int = STEPS, answers: int = 0
) -> DataFrame:
    """node_, other_, far_: the nearest nodes that greedy search finds for each node_ of ``starts``, the ``beam`` nearest
    or ``answers`` if that is more."""
    spark = nodes.sparkSession
    sent = spark.sparkContext.broadcast(pivots)
    own = keep(nodes.select("node_", "small_").join(starts, "node_", "left_semi"))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = sent.value.nearest(unpacked(batch.column(1)), STARTS) if len(batch) else np.zeros((0, 1), dtype=np.int64)
            ids = batch.column(0).to_numpy()
            yield _batch("node_ other_", pa.array(np.repeat(ids, near.shape[1])), pa.array(sent.value.ids[near].ravel()))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = ((unpacked(batch.column(2)) - unpacked(batch.column(3))) ** 2).sum(axis=1)
            yield _batch("node_ other_ far_", *batch.columns[:2], pa.array(far[: len(batch)].astype(np.float32)))

    def measured(pairs: DataFrame) -> DataFrame:
        """``pairs`` with their distances, not visited yet."""
        b = nodes.select(F.col("node_").alias("other_"), F.col("small_").alias("its_"))
        both = pairs.where("node_ <> other_").join(b, "other_").join(own, "node_").select("node_", "other_", "small_", "its_")
        return both.mapInArrow(measure, "node_ long, other_ long, far_ float").withColumn("seen_", F.lit(False))

    at_home = graph.join(own.select("node_"), "node_")
    first = own.mapInArrow(begin, "node_ long, other_ long").unionByName(at_home).distinct()
    order = Window.partitionBy("node_").orderBy("far_", "other_")
    most = max(beam, answers)

    def nearest_of(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("rank_", F.row_number().over(order)).where(F.col("rank_") <= most)

    # Only the nearest stay. What has dropped out never comes back, as nearer nodes have taken its place: if it is met
    # again, it is measured again and drops out again, which costs less than to keep and join all that was ever measured.
    top = keep(nearest_of(measured(first)))
    for _ in range(steps):
        todo = top.where(~F.col("seen_") & (F.col("rank_") <= beam)).select("node_", F.col("other_").alias("at_"))
        if todo.isEmpty():
            break
        near = todo.join(graph.withColumnRenamed("node_", "at_"), "at_").select("node_", "other_").distinct()
        fresh = measured(near.join(top.select("node_", "other_"), ["node_", "other_"], "left_anti"))
        # All that was to visit is visited in one step.
        visited = top.withColumn("seen_", F.col("seen_") | (F.col("rank_") <= beam)).drop("rank_")
        now = keep(nearest_of(visited.unionByName(fresh)))
        discard(top)
        top = now
    return top.select("node_", "other_", "far_")


def nearest(
    vectors: DataFrame,
    is_query=None,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    rounds: int = ROUNDS,
    beam: int = BEAM,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each query, by Euclidean distance.

    ``is_query`` is a condition on vec_id. A query is no candidate of its own; ties go to the smaller vec_id. See
    ``usable`` for rows that take no part, as queries too. Rows that repeat entirely count once; rows with one id and
    several vectors are several candidates. Of fewer than k + 1 rows, all others are returned. An empty table gives no
    rows. Other columns are ignored. ``k`` is below NEIGHBOURS, so that the members of a node are always enough.
    """
    if k >= NEIGHBOURS:
        raise ValueError(f"k must be below {NEIGHBOURS}")
    rows = keep(usable(vectors, id_col, vector_col))
    nodes = keep(nodes_of(rows))
    pivots = Pivots(nodes, nodes.count())
    if not len(pivots.ids):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    graph = neighbour_graph(nodes, pivots, rounds)
    asked = rows.where(is_query if is_query is not None else F.lit(True))
    queries = keep(asked.join(nodes.select("vector_", "node_"), "vector_").select(F.col("vec_id").alias("query_id"), "node_"))
    # Distances of the walk are rounded to 4 bytes in the end: several times k go into the exact comparison.
    several = 5 * k + 14
    found = walk(graph, nodes, queries.select("node_").distinct(), pivots, beam, answers=several)
    order = Window.partitionBy("node_").orderBy("far_", "other_")
    few = found.withColumn("rank_", F.row_number().over(order)).where(F.col("rank_") <= several)
    own = queries.select("node_").distinct().select("node_", F.col("node_").alias("other_"))
    pairs = few.select("node_", "other_").unionByName(own)
    a = nodes.select("node_", F.col("vector_").alias("a_"))
    b = nodes.select(F.col("node_").alias("other_"), F.col("vector_").alias("b_"), "members_")
    terms = F.zip_with("a_", "b_", lambda x, y: (x - y) * (x - y))
    score = F.sqrt(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x))
    scored = pairs.join(a, "node_").join(b, "other_").select("node_", score.alias("score"), F.explode("members_").alias("vec_id"))
    ranked = (
        queries.join(scored, "node_")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    )
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
