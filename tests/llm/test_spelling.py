import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ODD, rows_of

from fieldtrail.llm import spelling
from fieldtrail.llm.queries import QUERIES, misspelt


def neighbours(word, alphabet):
    """All texts that one inserted, deleted or replaced letter makes of a word."""
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in alphabet}
        if i < len(word):
            out.add(word[:i] + word[i + 1 :])
            out |= {word[:i] + c + word[i + 1 :] for c in alphabet}
    return out - {word}


def expected(counts):
    alphabet = sorted(set("".join(counts)))
    near = {w: [v for v in neighbours(w, alphabet) if v in counts] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def got(made):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows_of(made))


def random_counts(seed, size, alphabet):
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.choice([4, 5, 6, 7, 7, 8, 11, 30]))) for _ in range(size)}
    for word in list(words):
        for _ in range(rng.randrange(4)):
            word = rng.choice(sorted(neighbours(word, alphabet)))
            if len(word) >= 4:
                words.add(word)
    return {w: int(2 * 10 ** rng.uniform(0, 5)) for w in sorted(words)}


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize("seed, size, alphabet", [(1, 250, "ab"), (2, 400, "abcdeé"), (3, 300, "a"), (4, 500, "aæ☃𝔘bcdefgh")])
def test_against_all_neighbours(spark, seed, size, alphabet):
    counts = random_counts(seed, size, alphabet)
    want = expected(counts)
    assert got(spelling.variants(frame(spark, counts))) == want
    assert sum(r[4] for r in want) > (5 if alphabet == "a" else 100)


def test_parts_that_many_words_share(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TOGETHER", 5)
    counts = random_counts(5, 400, "abc") | {"q" * n: 7**k for k, n in enumerate(range(5, 15))}
    assert got(spelling.variants(frame(spark, counts))) == expected(counts)


@pytest.mark.parametrize("few, pieces", [(0, 8), (0, 3), (10**9, 8)])
def test_pairs_within_a_part(few, pieces, monkeypatch):
    """The index within a part finds what a look at all pairs does, and each pair once."""
    monkeypatch.setattr(spelling, "FEW", few)
    monkeypatch.setattr(spelling, "PIECES", pieces)
    spelling.cuts.cache_clear()
    words = random_counts(6, 400, "abcd") | {"a" * n: 2 for n in range(4, 12)}
    ranks = np.arange(spelling.CELLS)
    grams, parts = spelling.Grams(ranks, ranks), {}
    for word in words:
        last, (one, two), places = grams.of(word)
        for at in places:
            role = spelling.FIRST if at == one else spelling.SECOND if at == two else spelling.PREFIXED
            parts.setdefault((0, word[: at + 2]), []).append((at, role, last, one, word, 1))
            parts.setdefault((1, word[at:]), []).append((-1 - at, role, last, one, word, 1))
    found = [tuple(sorted((a[4], b[4]))) for group in parts.values() for a, b in spelling.near_in(group)]
    assert set(found) == {tuple(sorted((w, v))) for w in words for v in neighbours(w, "abcd") if v in words}
    assert len(found) < 1.1 * len(set(found))
    spelling.cuts.cache_clear()


def test_pivots_are_the_lightest_that_do_not_overlap():
    rng = random.Random(7)
    for _ in range(300):
        places = rng.sample(range(12), rng.randrange(5, 9))
        prefix = [(at, rng.randrange(20)) for at in places]
        fitting = [c for c in itertools.combinations(sorted(prefix), 2) if c[1][0] - c[0][0] >= 2]
        least = min(a[1] + b[1] for a, b in fitting)
        chosen = spelling.pivots(prefix)
        assert sum(dict(prefix)[at] for at in chosen) == least and chosen[1] - chosen[0] >= 2


def test_one_edit():
    words = ["".join(w) for n in range(5) for w in itertools.product("ab", repeat=n)]
    for a, b in itertools.product(words, words):
        assert spelling.one_edit(a, b) == (b in neighbours(a, "ab"))


def documents_counts(rows):
    counts = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_documents(make_docs, no_docs):
    rng = random.Random(8)
    words = ["".join(rng.choice("abÀéx") for _ in range(rng.choice([6, 7, 8]))) for _ in range(80)]
    rows = [*ODD, *((i, rng.choice([" ", ", ", "1"]).join(rng.choices(words, k=40)).title()) for i in range(100, 160))]
    want = expected(documents_counts(rows))
    assert got(spelling.spelling_variants(make_docs([*rows]), misspelt)) == want and any(r[1] for r in want)
    assert rows_of(spelling.spelling_variants(no_docs)) == []


def test_query(spark, small):
    docs = [(r.doc_id, r.text) for r in rows_of(spark.read.parquet(f"{small}/documents.parquet"))]
    assert got(QUERIES["op12_spelling"](spark, small)) == expected(documents_counts(docs))
