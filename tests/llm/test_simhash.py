import random

import numpy as np
import pytest
import xxhash
from conftest_llm import ODD, rows_of

from fieldtrail.llm import simhash
from fieldtrail.llm.components import components


def fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows, radius=3):
    prints = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min([x for x in (least.get(g), i) if x is not None], default=None)
    return sorted(((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, group)), key=str)


def groups_of(made):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows_of(made)), key=str)


def test_against_all_pairs(make_docs):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 30, 200]))]
        for copy in range(rng.choice([1, 1, 2, 4])):
            if copy and len(words) > 20:
                words = list(words)
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((1000 * copy + i, rng.choice([" ", "\n", "\t "]).join(words).title()))
    rng.shuffle(rows)
    assert groups_of(simhash.near_groups(make_docs(rows))) == expected(rows)


def test_odd_rows(odd_docs, no_docs):
    assert groups_of(simhash.near_groups(odd_docs)) == expected(ODD)
    assert rows_of(simhash.near_groups(no_docs)) == []


def all_links(fps, radius):
    return {(min(a, b), max(a, b)) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= radius}


def connected(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    groups = {}
    for x in root:
        groups.setdefault(find(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


@pytest.fixture(scope="module")
def clumps():
    """Random fingerprints, chains of near ones, and a clump in which nearly all pairs link."""
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(1500)}
    for start in list(fps)[:200]:
        for _ in range(rng.randrange(6)):
            start ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 4)))
            fps.add(start)
    middle = rng.getrandbits(64)
    fps |= {middle ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(0, 64, 7)}
    return sorted(fps)


def test_tree_loses_no_link(clumps, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 40)  # so that shards are split in memory too
    fps = np.array(clumps, dtype=np.uint64)
    found = set()
    for _, home, visit in simhash.Tree(fps[::7], 12).route(fps, 3, True):
        a, b = simhash.near_links(home, visit, 3)
        found |= set(zip(a.tolist(), b.tolist()))
    assert len(found) < 8 * len(fps)  # forests, not all pairs
    assert connected(found) == connected(all_links(clumps, 3))


def test_divided_shards_lose_no_link(spark, clumps, monkeypatch):
    monkeypatch.setattr(simhash, "TASK", 100)
    prints = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in clumps], "fp_ long")
    got = {(r.a_ % 2**64, r.b_ % 2**64) for r in rows_of(simhash.fingerprint_links(prints))}
    assert connected(got) == connected(all_links(clumps, 3))


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(500, i) for i in range(100, 180)] + [(7, 7), (900, 901), (901, 900), (-5, 902)]
    got = {r.node_: r.component_ for r in rows_of(components(spark.createDataFrame(links, "a_ long, b_ long")))}
    want = {x: min(g) for g in connected({(a, b) for a, b in links if a != b}) for x in g}
    assert got == want
    assert rows_of(components(spark.createDataFrame([], "a_ long, b_ long"))) == []


def test_one_of_each_group_stays(make_docs):
    text = " ".join(f"w{i}" for i in range(400))
    docs = make_docs(
        [(5, text), (3, text), (3, text), (4, text + " end"), (1, "something else entirely here"), (None, text), (7, ""), (6, None)]
        + [(8, "of its own kind one"), (8, "quite another text two"), (None, "without any id three")]
    )
    made = simhash.one_of_each_group(docs)
    assert made.columns == docs.columns
    got = sorted((str(r.doc_id), r.text) for r in rows_of(made))
    want = [("1", "something else entirely here"), ("3", text), ("6", None), ("8", "of its own kind one"),
            ("8", "quite another text two"), ("None", "without any id three")]
    assert got == want
    assert rows_of(simhash.one_of_each_group(docs.limit(0))) == []


def test_one_row_stays_for_each_component(make_docs, odd_docs):
    for docs in (odd_docs, make_docs([(i, " ".join(f"w{(i % 7) * 50 + j}" for j in range(80))) for i in range(50)])):
        groups = {r.component_id for r in rows_of(simhash.near_groups(docs))}
        stay = [r.doc_id for r in rows_of(simhash.one_of_each_group(docs))]
        assert len(stay) == len(groups) and set(stay) == groups


def test_fingerprints_are_made_in_portions():
    """What a task holds doesn't grow with the texts of a batch: hashes and counters take many times their room."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10**4)}" for _ in range(4000)) for _ in range(80)]
    texts += [None, "", "word " * 60_000, "a b", None]
    tracemalloc.start()
    got = simhash.prints_of(pa.array(texts), 3)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.tolist() == [fingerprint(t) for t in texts]
    assert simhash.prints_of(pa.array([], pa.string()), 3).tolist() == []
    assert most < 30e6
