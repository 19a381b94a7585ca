import random

import numpy as np
import pytest
from conftest_llm import rows_of

from fieldtrail.llm import language

PARTS = {
    "xa": ["ba", "ko", "ti", "mun", "rak"],
    "xb": ["sch", "ei", "der", "ung", "öl"],
    "xc": ["ция", "ко", "ра", "не", "ств"],
}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    rows = []
    for i in range(450):
        lang = rng.choice(list(PARTS))
        words = ["".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.choice([2, 10, 80, 900]))]
        rows.append((i, " ".join(words), lang, "s"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_held_out_documents(docs):
    got = rows_of(language.identify(docs).withColumn("out", language.held_out()))
    out = [r for r in got if r.out]
    assert len(out) > 50 and sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_kernel_matrix_is_the_kernel(docs):
    """What the folded matrix gives is what kernel values of whole texts give."""
    a, b = "ba ko tirak", "tirak munba x"
    ra, rb = (set(language.runs(t)[0]) for t in (a, b))
    pieces = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    pa, pb = pieces(f" {a} "), pieces(f" {b} ")
    assert (len(ra), len(rb), len(ra & rb)) == (len(pa), len(pb), len(pa & pb))
    long = "ba ko " * 3000 + "ünd 123"
    codes, letters = language.runs(long)
    assert letters and len(codes) == len(np.unique(codes))


def test_odd_rows(odd_docs, no_docs, docs):
    got = rows_of(language.identify(odd_docs))
    assert len(got) == odd_docs.count()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in got)
    assert rows_of(language.identify(no_docs)) == []
    unknown = docs.withColumn("lang", language.F.lit(None).cast("string")).limit(5)
    assert {(r.lang_pred, r.score) for r in rows_of(language.identify(unknown))} == {("und", 0.0)}


def test_only_letters_beyond_the_first_plane_count():
    assert [language.runs(t)[1] for t in ("😀 🚀", "🚀 𝔘", "𠀀", "1 ☃")] == [False, True, True, False]
