import random

import pytest
from conftest_llm import rows_of

from fieldtrail.llm import secrets
from fieldtrail.llm.store import keep


def hexes(rng, n):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


@pytest.fixture(scope="module")
def corpus(make_docs):
    rng = random.Random(13)
    words = "the report about orders was written in winter and nobody read section annex".split()
    rows, truth = [], {}
    for i in range(500):
        text = [rng.choice(words) for _ in range(60)]
        at = 10 + rng.randrange(40)
        if i % 3 == 0:
            value = hexes(rng, 40)
            text[at : at + 3] = [rng.choice(["token", "api_key", "secret"]), "=", f'"{value}"']
        else:
            value = rng.choice(["order-number-2024-00", "section.and.annex.", "99887766554433"]) + str(rng.randrange(10_000, 99_999))
            text[at] = value
        rows.append((i, " ".join(text)))
        truth[i] = (value, int(i % 3 == 0))
    return make_docs(rows), truth


def test_forest_on_held_out_documents(corpus):
    docs, truth = corpus
    got = rows_of(secrets.scan(docs))
    assert {r.doc_id for r in got} == set(truth)
    right = [(r.candidate, r.predicted) == truth[r.doc_id] for r in got]
    assert sum(right) / len(right) > 0.98 and all(0 <= r.score <= 1 for r in got)


def test_labels_by_hand_decide(corpus, spark):
    docs, truth = corpus
    found = rows_of(secrets.findings(docs))
    # Someone says that the order numbers are secrets.
    rows = [(r.doc_id, r.word_no, r.candidate, int(r.candidate.startswith("order"))) for r in found]
    labels = spark.createDataFrame(rows, "doc_id long, word_no int, candidate string, label int")
    got = rows_of(secrets.scan(docs, labels))
    right = [r.predicted == r.candidate.startswith("order") for r in got]
    assert sum(right) / len(right) > 0.98


def test_candidates(make_docs):
    rows = [
        (1, 'password: "hunter2x" and next'),
        (2, "set API_KEY=abcdef123456 now"),
        (3, "a/b1c2d3e4f5a6b7c8d9e0,x0x1x2x3x4x5x6x7x8x9"),
        (4, "justaverylongwordwithoutanydigit short 12345"),
        (5, "x " * 30_000 + "token = '" + "a1" * 50_000 + "'"),
    ]
    got = {(r.doc_id, r.word_no, r.candidate): (r.before, r.after) for r in rows_of(secrets.findings(make_docs(rows)))}
    assert set(got) == {
        (1, 1, "hunter2x"), (2, 1, "abcdef123456"), (3, 0, "a/b1c2d3e4f5a6b7c8d9e0"), (3, 0, "x0x1x2x3x4x5x6x7x8x9"),
        (5, 30_002, "a1" * 50_000),
    }
    assert got[1, 1, "hunter2x"] == (["", "", "password:"], "and")


def test_short_values_beside_runs_and_signs(make_docs):
    rows = [
        (1, '{"id":"a1b2c3d4e5f6a7b8","password":"hunter22"}'),
        (2, '{"password":"hunter22"}'),
        (3, "https://h/?user=me&password=hunter22&x=1"),
        (4, "pwd=ab:cd=ef12 secret: hunter=2:x4"),
        (5, '{"token":"abcdef1","pwd":"ghijkl2","n":3}'),
        (6, "{password:hunter22,user:bob}"),
    ]
    got = {}
    for r in rows_of(secrets.findings(make_docs(rows))):
        got.setdefault(r.doc_id, []).append(r.candidate)
    assert got[1] == ["a1b2c3d4e5f6a7b8", "hunter22"]
    assert got[2] == ["hunter22"] and got[3] == ["hunter22"] and got[6] == ["hunter22"]
    assert got[4] == ["ab:cd=ef12", "hunter=2:x4"]
    assert got[5] == ["abcdef1", "ghijkl2"]


def test_coverage_is_the_share_of_letters_in_words(spark):
    words = spark.createDataFrame([("order",), ("orders",), ("ness",)], "part string")
    candidates = spark.createDataFrame([("Orders12",), ("orderness",), ("zzz",), ("0123456789",)], "candidate string")
    got = {r.candidate: r.coverage for r in rows_of(secrets.coverage(candidates, words))}
    assert got == {"Orders12": 0.75, "orderness": 1.0, "zzz": 0.0, "0123456789": 0.0}


def test_odd_rows(odd_docs, no_docs, make_docs):
    assert rows_of(secrets.scan(odd_docs)) == [] and rows_of(secrets.scan(no_docs)) == []
    one = make_docs([(None, "token = 'a1b2c3d4e5f6a7b8c9d0'"), (1, "token = 'a1b2c3d4e5f6a7b8c9d0'"), (1, "token = 'a1b2c3d4e5f6a7b8c9d0'")])
    assert len(rows_of(secrets.scan(one))) == 3


@pytest.fixture
def small_broadcasts(spark):
    limit = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "24m")  # a page of memory is up to 16 MB here
    yield
    spark.conf.set(limit, before)


def test_pieces_of_candidates_are_not_broadcast(spark, small_broadcasts):
    rng = random.Random(1)
    values = [hexes(rng, 36) + "deed" for _ in range(6_000)]
    candidates = keep(spark.createDataFrame([(v,) for v in values], "candidate string"))
    words = spark.createDataFrame([("deed",)], "part string")
    got = {r.candidate: r.coverage for r in rows_of(secrets.coverage(candidates, words))}
    assert set(got) == set(values) and min(got.values()) == 0.1


def test_findings_in_one_long_word_are_not_broadcast(make_docs, small_broadcasts):
    rng = random.Random(1)
    word = lambda: ",".join(f'"key":"{hexes(rng, 40)}"' for _ in range(1_000))
    docs = make_docs([(i, f"the values are {word()} in here") for i in range(2)])
    assert len(rows_of(secrets.scan(docs))) == 2_000
