import random

import pytest
from conftest_llm import rows_of
from pyspark.sql import functions as F

from fieldtrail.llm import toxicity

BAD = ["vile", "rotten", "foulish", "foulest"]


def brute_segments(scores):
    """All maximal segments, by the definition: best segment, then the same on both sides of it."""
    if not scores:
        return []
    best = max(((sum(scores[i : j + 1]), -(j - i), -i) for i in range(len(scores)) for j in range(i, len(scores))))
    total, first, last = best[0], -best[2], -best[1] - best[2]
    if total <= 0:
        return []
    left = brute_segments(scores[:first])
    right = [(s, a + last + 1, b + last + 1) for s, a, b in brute_segments(scores[last + 1 :])]
    return [*left, (total, first, last), *right]


def test_segments_are_all_the_maximal_ones():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randrange(25)
        hits = [(i, rng.choice([1.0, 2.0, 3.5])) for i in range(n) if rng.random() < 0.4]
        scores = [-0.75] * n
        for i, s in hits:
            scores[i] = s
        got = sorted((a, b, round(s, 6)) for s, a, b in toxicity.segments(hits, -0.75))
        assert got == sorted((a, b, round(s, 6)) for s, a, b in brute_segments(scores))


def test_many_lone_hits_take_one_pass():
    assert len(toxicity.segments([(100 * i, 1.0) for i in range(200_000)])) == 200_000


@pytest.fixture(scope="module")
def corpus(make_docs, spark):
    rng = random.Random(8)
    words = [a + b for a in "bcdfgh" for b in ("ano", "eri", "ulum", "ost")]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 200))]
        toxic = i % 4 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_held_out_documents(corpus):
    docs, labels, truth = corpus
    scored = rows_of(toxicity.toxicity(docs, labels).select("doc_id", "score", "predicted", toxicity.held_out().alias("out")))
    out = [r for r in scored if r.out]
    assert len(out) > 40 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored)
    assert sum(r.predicted == truth[r.doc_id] for r in out) / len(out) > 0.97
    assert rows_of(toxicity.without_toxic(docs, labels).select("score"))[0].score == "s"


def test_labels_of_held_out_rows_change_nothing(corpus):
    docs, labels, _ = corpus
    turned = F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, labels.withColumn("toxic", turned))


def test_passages_have_places(corpus, make_docs):
    docs, labels, _ = corpus
    model = toxicity.fit(docs, labels)
    text = "bano " * 300 + "vile rotten vile " + "ceri " * 300 + "foulest vile foulish rotten " + "dost " * 50
    found = rows_of(toxicity.find_passages(make_docs([(1, text), (2, None), (3, "bano")]), model))
    assert {(r.doc_id, r.first, r.last) for r in found} == {(1, 300, 302), (1, 603, 606)}


def test_odd_rows(odd_docs, no_docs, corpus, spark):
    _, labels, _ = corpus
    scores = [r.score for r in rows_of(toxicity.toxicity(odd_docs, labels.limit(0)))]
    assert len(scores) == odd_docs.count() and max(scores) < 0.5
    odd_labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (8, 1), (9, 0), (7, 0)], "doc_id long, toxic int")
    assert len(rows_of(toxicity.toxicity(odd_docs, odd_labels))) == odd_docs.count()
    assert rows_of(toxicity.toxicity(no_docs, labels)) == []


@pytest.mark.parametrize("most", [1, 7, 40, 10_000])
def test_a_sample_has_the_first_rows_of_each_value(spark, most):
    from pyspark.sql import functions as F

    from fieldtrail.llm.store import some_of_each

    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 50 == 0).cast("int").alias("toxic"))
    got = sorted((r.toxic, r.doc_id) for r in some_of_each(rows, "toxic", ["doc_id"], most).collect())
    want = []
    for label in (0, 1):
        ordered = rows.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        want += [(label, r.doc_id) for r in ordered.collect()]
    assert got == sorted(want)


def test_forms_leave_in_portions():
    """What a task holds doesn't grow with the texts of a batch: forms take many times their room."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(9)
    texts = [" ".join(f"{rng.randrange(10**9):x}".translate(str.maketrans("0123456789", "ghijklmnop")) for _ in range(5000)) for _ in range(40)]
    texts += [None, "", "word " * 20_000, "12 34"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 2 for i in range(len(texts))], pa.int32())], ["text", "toxic"])
    got = [0, 0]
    tracemalloc.start()
    for rows in toxicity._token_rows(iter([batch, batch.slice(40)])):
        for label in rows.column(1).to_pylist():
            got[label] += 1
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = [0, 0]
    for i, text in [*enumerate(texts), *enumerate(texts[40:])]:
        want[i % 2] += len({f for word in set(toxicity.tokens(text)) for f in toxicity.forms(word)})
    assert got == want
    assert most < 30e6
