import hashlib
import random

import pytest
from conftest_llm import ODD, rows_of

from fieldtrail.llm.lines import dedup_lines, without_repeated_lines
from fieldtrail.llm.mph import PerfectHash, Shard

WHITE = " \t\n\x0b\x0c\r"


def expected(rows, min_docs=3, min_chars=20):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(WHITE).translate(fold)
    number = lambda i: -(2**63) if i is None else i
    holders = {}
    for n, (i, t) in enumerate(rows):
        for k in {key(line) for line in (t or "").split("\n")}:
            holders.setdefault(k, {})[n] = number(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = lambda k: len(k) >= min_chars and len(holders[k]) >= min_docs and max(holders[k].values()) != number(i)
        left = [line for line in lines if not gone(key(line))]
        text = "\n".join(left)
        out.append((i, len(lines), len(lines) - len(left), hashlib.sha256(text.encode()).hexdigest(), None if t is None else text))
    return sorted(out, key=str)


def lines_of(made):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256, r.text) for r in rows_of(made)), key=str)


@pytest.fixture(scope="module")
def shared_lines():
    rng = random.Random(2)
    common = [f"Common line number {i} of the corpus" for i in range(40)]
    rows = []
    for i in range(120):
        lines = [rng.choice(common) if rng.random() < 0.5 else f"Line {rng.random()} of its own, {i}" for _ in range(rng.randrange(12))]
        lines = [rng.choice([str.upper, str.lower, str])(x) + rng.choice(["", " ", "\t\r"]) for x in lines] + ["hot line in all documents!"]
        rows.append((i if i % 9 else None, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "task_rows": 20, "shard_keys": 8}])
def test_both_ways_of_probing(make_docs, odd_docs, no_docs, shared_lines, options):
    assert lines_of(dedup_lines(make_docs(shared_lines), **options)) == expected(shared_lines)
    assert lines_of(dedup_lines(odd_docs, **options)) == expected(ODD)
    assert rows_of(dedup_lines(no_docs, **options)) == []


def test_documents_keep_their_columns(make_docs, shared_lines):
    docs = make_docs(shared_lines)
    made = without_repeated_lines(docs)
    assert made.columns == docs.columns
    got = rows_of(made)
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(e[0]), e[4]) for e in expected(shared_lines))
    assert all(r.n_chars == len(r.text) and r.row_ == "r" for r in got)


def test_perfect_hash_is_minimal_and_tells_strangers():
    import numpy as np

    keys = np.random.default_rng(0).choice(2**62, 5000, replace=False).astype(np.uint64)
    for n in (1, 2, 64, 5000):
        assert sorted(PerfectHash.build(keys[:n]).index(keys[:n])) == list(range(n))
    shard = Shard.from_bytes(Shard.build(keys, keys.view(np.int64) + 7, {"v": keys}).to_bytes())
    assert (shard.values["v"][shard.lookup(keys, keys.view(np.int64) + 7)] == keys).all()
    assert (shard.lookup(keys, keys.view(np.int64)) == -1).all()
    empty = Shard.build(keys[:0], keys[:0].view(np.int64), {"v": keys[:0]})
    assert (empty.lookup(keys[:3], keys[:3].view(np.int64)) == -1).all()


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_rows_beyond_a_slice(make_docs, shared_lines, options):
    """Batches of more text than a task takes at once, with texts that are more alone."""
    rows = [(i, t + "\n" + f"filler {n % 3} " * 4000 + "\n" + t.upper()) for n, (i, t) in enumerate(shared_lines)]
    rows += [(500, None), (501, "x" * 1_500_000), (None, ""), (502, "a line that is here twice\n" * 70_000)]
    assert lines_of(dedup_lines(make_docs(rows).coalesce(2), **options)) == expected(rows)


def test_slices_are_the_batch_in_bounded_parts():
    import pyarrow as pa

    from fieldtrail.llm.store import slices

    texts = ["é" * 30, None, "", "x" * 500, "y" * 40, None, "z" * 60, "a", "b" * 101]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], ["n", "text"])
    for whole in (batch, batch.slice(2, 5), batch.slice(1, 1), batch.slice(0, 0)):
        parts = list(slices(whole, 1, 100))
        assert [n for p in parts for n in p.column(0).to_pylist()] == whole.column(0).to_pylist()
        assert [t for p in parts for t in p.column(1).to_pylist()] == whole.column(1).to_pylist()
        sizes = [sum(len((t or "").encode()) for t in p.column(1).to_pylist()) for p in parts]
        assert all(size <= 100 or len(p) == 1 for size, p in zip(sizes, parts))
    assert [len(p) for p in slices(batch, 1, 100)] == [3, 1, 3, 1, 1]
