import random

import pytest
from conftest_llm import ODD, rows_of

from fieldtrail.llm.mixing import mix_plan, mixed


def size_of(text):
    return len((text or "").encode().split())


def expected_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Share by weight, stop at the limit, share what is above again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, rest, open_ = {}, share * sum(sizes.values()), list(names)
    while open_:
        level = rest / sum(weight[s] for s in open_)
        above = [s for s in open_ if weight[s] * level > most * sizes[s]]
        if not above:
            return full | {s: weight[s] * level for s in open_}
        for s in above:
            full[s] = most * sizes[s]
            rest -= full[s]
            open_.remove(s)
    return full


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    sources = ["b", "a", "é", "z", None, "hot", "hot", "hot"]
    return [(i, " ".join(["x"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(sources)) for i in range(600)]


def test_targets_and_budgets(make_docs, rows):
    docs = make_docs(rows)
    got = {r.doc_id: r for r in rows_of(mix_plan(docs))}
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    targets, taken = expected_targets(sizes), dict.fromkeys(sizes, 0)
    for i, text, source in rows:
        r = got[i]
        assert (r.size, r.source_size) == (size_of(text), sizes[source])
        assert r.target == pytest.approx(targets[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    # The same mix from other partitions, in another order.
    again = {r.doc_id: r.taken for r in rows_of(mix_plan(docs.orderBy("text").repartition(7)))}
    assert again == {i: r.taken for i, r in got.items()}


def test_odd_rows(odd_docs, no_docs):
    got = rows_of(mix_plan(odd_docs))
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), size_of(t)) for i, t in ODD)
    total = sum(size_of(t) for _, t in ODD)
    assert abs(sum(r.taken for r in got) - 1.5 * total) <= len(got)
    assert rows_of(mix_plan(no_docs)) == []


def test_sources_without_words(make_docs):
    got = rows_of(mix_plan(make_docs([(1, "", "a"), (2, None, "b"), (3, "x y", "c")])))
    assert {r.doc_id: (r.target, r.taken) for r in got} == {1: (0.0, 0), 2: (0.0, 0), 3: (3.0, 3)}


def test_rows_of_the_mix(make_docs, rows):
    docs = make_docs(rows)
    made = mixed(docs)
    assert made.columns == docs.columns
    words = {}
    for r in rows_of(made):
        words[r.doc_id] = words.get(r.doc_id, 0) + size_of(r.text)
        assert r.n_chars == len(r.text) and r.size_ == "z"
    assert {i: w for i, w in words.items() if w} == {r.doc_id: r.taken for r in rows_of(mix_plan(docs)) if r.taken}
    # Documents without words cost nothing and stay.
    assert {i for i, t, _ in rows if not size_of(t)} <= words.keys()
