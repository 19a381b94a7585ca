import random

import numpy as np
import pytest
from conftest_llm import ODD, rows_of

from fieldtrail.llm import minhash
from fieldtrail.llm.queries import QUERIES


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2)))


def expected(rows, percent=85):
    """One after the other, each set against all before it."""
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    least = {}
    for i, (id_, _) in enumerate(rows):
        least[find(i)] = min([x for x in (least.get(find(i)), id_) if x is not None], default=None)
    made = [(id_, len(sets[i]), least[find(i)]) for i, (id_, _) in enumerate(rows)]
    return sorted(((*m, m[0] == m[2]) for m in made), key=str)


def got(made):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows_of(made)), key=str)


def families(seed, count):
    """Texts with copies in which single words differ, at similarities around the bound."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(80)]
    for _ in range(count):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 20, 90, 150, 600]))]
        base = base + passage if rng.random() < 0.3 else base
        for copy in range(rng.choice([1, 2, 3, 6])):
            words = list(base)
            for _ in range(copy and rng.choice([0, 1, max(1, len(words) // 40), len(words) // 15])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append(rng.choice([" ", "\n", "\t "]).join(words).title())
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_against_all_pairs(make_docs):
    rows = families(1, 90)
    want = expected(rows)
    assert got(minhash.near_groups(make_docs(rows))) == want
    assert sum(not kept for *_, kept in want) > 40


def test_hot_buckets_lose_nothing(make_docs, monkeypatch):
    """Hundreds of texts of one template, many of them similar to few others only: after one round of chosen ones, the
    rest is compared in blocks."""
    monkeypatch.setattr(minhash, "ROUNDS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 50 * 148)
    monkeypatch.setattr(minhash, "PARTS", 4)
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(260):
        words = list(base)
        for k in range(rng.choice([2, 5, 6, 7])):
            words[rng.randrange(150)] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(words)))
    want = expected(rows)
    assert got(minhash.near_groups(make_docs(rows))) == want
    assert 5 < len({c for _, _, c, _ in want}) < 200


def test_odd_rows(odd_docs, no_docs):
    made = minhash.near_groups(odd_docs)
    want = [(i, n, c, i == c) for i, n, c, _ in expected(ODD)]
    assert got(made) == sorted(want, key=str)
    assert rows_of(minhash.near_groups(no_docs)) == []


def one_by_one(hashes, places):
    """SuperMinHash as it is written for one shingle after the other."""
    best = [float("inf")] * places
    for i in range(len(hashes)):
        order = list(range(places))
        for level in range(places):
            x = int(minhash._random(hashes[i : i + 1], level)[0])
            k = level + x % (places - level)
            order[level], order[k] = order[k], order[level]
            best[order[level]] = min(best[order[level]], level + (x >> 20) / 2**44)
    return best


@pytest.mark.parametrize("n", [1, 2, 7, 60, 400])
def test_signature_stops_early_with_the_same_values(n):
    hashes = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    made = minhash.signature(hashes)
    want = one_by_one(hashes, minhash.PLACES)
    assert [v / 2**44 for v in made.tolist()] == pytest.approx(want, abs=1e-12)


def test_estimates_scatter_less_than_independent_ones():
    rng = np.random.default_rng(3)
    errors, n, places = [], 60, minhash.PLACES
    for _ in range(300):
        x = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        a, b = minhash.signature(x[: n + n // 2]), minhash.signature(x[n // 2 :])
        errors.append((a == b).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02
    assert np.var(errors) < 0.5 * 0.5 / places


def test_query(spark, small):
    docs = [(r.doc_id, r.text) for r in rows_of(spark.read.parquet(f"{small}/documents.parquet"))]
    assert got(QUERIES["op11_minhash"](spark, small)) == expected(docs)
