import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest_llm import ODD, rows_of

from fieldtrail.llm import repeats
from fieldtrail.llm.queries import QUERIES, with_periodic_tails


def brute_runs(words):
    """Every stretch that keeps a period as long as it can, with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            found.setdefault((i, end + q - i), q)  # periods come in ascending order
            i = end + 1
    return sorted((s, n, q) for (s, n), q in found.items() if n >= max(6, 4 * q))


def brute_row(text):
    words = (text or "").encode().split()
    runs = brute_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    collapsed = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())


def sequences():
    rng = random.Random(5)
    for _ in range(1500):
        letters = rng.choice([1, 2, 2, 3, 5, 40])
        words = [rng.randrange(letters) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):  # repetitions of repetitions
            at = rng.randrange(len(words) + 1)
            unit = words[at : at + rng.randrange(1, 9)]
            words[at:at] = (unit * rng.randrange(2, 9))[: rng.randrange(1, 80)]
        yield words


def test_runs_against_brute_force():
    some = 0
    for words in sequences():
        want = brute_runs(words)
        assert repeats.runs_of(np.array(words, dtype=np.int64)) == want, words
        some += len(want)
    assert some > 1500


def test_suffix_order_and_shared_words():
    rng = random.Random(6)
    for _ in range(200):
        ids = np.array([rng.randrange(3) for _ in range(rng.randrange(2, 60))], dtype=np.int64)
        order, shared = repeats.sorted_suffixes(ids, np.arange(len(ids)))
        whole = [ids[i:].tolist() for i in order]
        assert whole == sorted(whole)
        for i in range(1, len(whole)):
            same = next((k for k, (a, b) in enumerate(zip(whole[i - 1], whole[i])) if a != b), min(map(len, whole[i - 1 : i + 1])))
            assert shared[i] == same


def test_long_repetitions_stay_fast():
    """Forests of equal words, of a period, and of many equal lines with words of their own between."""
    lines = [x for i in range(4000) for x in (1, 2, 3, 4, 5, 6, 100 + i)]
    for words, runs in [([7] * 60_000, 1), ([1, 2, 3] * 20_000, 1), (lines, 0), (lines + [1, 2, 3, 4, 5, 6] * 3000, 1)]:
        assert len(repeats.runs_of(np.array(words, dtype=np.int64))) == runs


def test_documents(make_docs, no_docs):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(80))) for _ in range(60)]
    rows = [*ODD, *((100 + i, t) for i, t in enumerate(texts)), (100, texts[0])]
    made = rows_of(repeats.periodic_runs(make_docs(rows)))
    fields = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(((r.doc_id, *(r[f] for f in fields)) for r in made), key=str)
    want = sorted(((i, *brute_row(t if i != 8 else "word " * 200)) for i, t in rows), key=str)
    # A text of 60,000 equal words is too long for the other way.
    long_ = (1, 0, 60_000, 1, 60_000_000, hashlib.sha256(b"0,60000,1\n").hexdigest(), hashlib.sha256(b"word").hexdigest())
    assert got == sorted([*(w for w in want if w[0] != 8), (8, *long_)], key=str)
    for r in made:
        assert hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256 and len(r.runs) == r.n_runs
    assert rows_of(repeats.periodic_runs(no_docs)) == []


def expected_tail(id_, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(id_).encode()), len(words)
    if id_ is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return b" ".join(words).decode()


def test_query(spark, small, odd_docs):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: tuple(r[1:]) for r in rows_of(QUERIES["op13_periodic_runs"](spark, small))}
    want = {r.doc_id: brute_row(expected_tail(r.doc_id, r.text)) for r in rows_of(docs) if len((r.text or "").split()) < 1500}
    assert {i: got[i] for i in want} == want and len(want) > 150
    assert len(got) == docs.count() and sum(r[0] > 0 for r in got.values()) > 5
    made = sorted((str(r.doc_id), " ".join((r.text or "").split())) for r in rows_of(with_periodic_tails(odd_docs)))
    assert made == sorted((str(i), " ".join(expected_tail(i, t).split())) for i, t in ODD)


@pytest.mark.parametrize("text", [None, "", " \n\t", "one", "a a a a a", "a a a a a a"])
def test_short_texts(text):
    assert repeats.described(text)[:7] == brute_row(text)
