import math

import numpy as np
import pytest
from conftest_llm import rows_of
from pyspark.sql import functions as F

from fieldtrail.llm.ann import Pivots, nearest, neighbour_graph, nodes_of, usable, walk

SCHEMA = "vec_id long, embedding array<float>, label int, far_ string, node_ string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "f", "n") for i, v in rows], SCHEMA)


def brute(rows, k=10):
    rows = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows]
    out = {}
    for i, v in rows:
        if i % 100 == 0:
            out[i] = sorted((math.sqrt(((v - w) ** 2).sum()), j) for j, w in rows if j != i)[:k]
    return out


def found(made):
    out = {}
    for r in sorted(rows_of(made), key=lambda r: r.rank):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(10)
    middles = rng.normal(size=(12, 24))
    rows = [(i, (middles[i % 12] + rng.normal(size=24)).tolist()) for i in range(3000)]
    got, want = found(nearest(table(spark, rows), F.col("vec_id") % 100 == 0)), brute(rows)
    assert got.keys() == want.keys()
    hits = [len({j for _, j in got[q]} & {j for _, j in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.95
    vectors = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    for q, answers in got.items():
        assert answers == sorted(answers) and q not in {j for _, j in answers}
        assert all(s == pytest.approx(math.sqrt(((vectors[q] - vectors[j]) ** 2).sum()), abs=1e-12) for s, j in answers)


@pytest.mark.parametrize("count, list_rows", [(2000, 1024), (5000, 60)])
def test_recall_on_random_directions(spark, count, list_rows, monkeypatch):
    """Unit vectors without any clusters; in the second case every list of the first graph is dealt into parts."""
    monkeypatch.setattr("fieldtrail.llm.ann.LIST_ROWS", list_rows)
    vectors = np.random.default_rng(13).normal(size=(count, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = list(enumerate(vectors.tolist()))
    got, want = found(nearest(table(spark, rows), F.col("vec_id") % 100 == 0)), brute(rows)
    assert np.mean([len({j for _, j in got[q]} & {j for _, j in want[q]}) / 10 for q in want]) >= 0.95


def test_a_walk_keeps_the_nearest_only(spark):
    """What a walk keeps, and joins at each step, does not grow with the nodes it has met."""
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(14).normal(size=(900, 8)))]
    nodes = nodes_of(usable(table(spark, rows), "vec_id", "embedding")).cache()
    pivots = Pivots(nodes, 900)
    starts = nodes.where("node_ % 100 = 0").select("node_")
    graph = neighbour_graph(nodes, pivots)
    for answers, most in ((10, 24), (40, 40)):
        found = rows_of(walk(graph, nodes, starts, pivots, beam=24, answers=answers))
        for q, want in brute(rows).items():
            mine = [r.other_ for r in sorted(found, key=lambda r: r.far_) if r.node_ == q]
            assert len(mine) == len(set(mine)) == most
            assert len(set(mine[:10]) & {j for _, j in want}) >= 9
    nodes.unpersist()


def test_near_copies_are_told_apart(spark):
    rng = np.random.default_rng(12)
    middle = rng.normal(size=16)
    rows = [(i, (middle + 1e-4 * rng.normal(size=16) if i % 3 else rng.normal(size=16)).tolist()) for i in range(3000)]
    got, want = found(nearest(table(spark, rows), F.col("vec_id") % 100 == 0)), brute(rows)
    hits = [len({j for _, j in got[q]} & {j for _, j in want[q]}) / 10 for q in want if q % 3]
    assert np.mean(hits) >= 0.95


def test_equal_vectors_and_ties(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).round(1).tolist()) for i in range(700)]
    got, want = found(nearest(table(spark, rows), F.col("vec_id") % 100 == 0)), brute(rows)
    for q in want:
        assert [j for _, j in got[q]] == [j for _, j in want[q]]


def test_rows_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (100, [1.0, 1.0]), (1, None), (2, [0.0, 0.0]), (200, [0.0, 0.0]), (3, [None, 1.0]),
        (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (7, []), (None, [1.0, 1.0]), (8, [3.0, 1.0]), (8, [3.0, 1.0]),
    ]
    got = found(nearest(table(spark, rows), F.col("vec_id") % 100 == 0))
    assert {q: [j for _, j in a] for q, a in got.items()} == {0: [100, 8], 100: [0, 8]}
    got = found(nearest(table(spark, [(0, [3.0]), (1, [3.0, 1.0]), (2, [1.0, 0.0])]), F.col("vec_id") == 0))
    assert got == {0: [(1.0, 1), (2.0, 2)]}  # a shorter vector goes on with zeros
    assert rows_of(nearest(table(spark, []))) == []
    assert rows_of(nearest(table(spark, [(0, [1.0])]))) == []
