import random
import struct
import zlib

import pytest
from conftest_llm import ODD, rows_of

from fieldtrail.llm import packing
from fieldtrail.llm.queries import tokenizer


def check(made, rows, capacity):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(tokenizer())
    want = []
    for i, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            cut = ids[k : k + capacity]
            want.append((i, k // capacity, k, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))))
    got = rows_of(made)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    return check_sequences([(r.sequence_id, r.offset, r.length) for r in got], capacity)


def check_sequences(placed, capacity):
    sequences = {}
    for s, at, n in placed:
        sequences.setdefault(s, []).append((at, n))
    for parts in sequences.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= capacity
    return len(sequences)


def best_fit_decreasing(sizes, capacity):
    gaps = []
    for n in sorted(sizes, reverse=True):
        fitting = [g for g in gaps if g >= n]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_odd_rows(odd_docs, no_docs, capacity):
    rows = [*ODD[:-2]]
    check(packing.packed(odd_docs.where("doc_id is null or doc_id < 8"), tokenizer(), capacity), rows, capacity)
    assert rows_of(packing.packed(no_docs, tokenizer(), capacity)) == []


def test_very_long_texts(odd_docs):
    check(packing.packed(odd_docs, tokenizer()), ODD, 2048)


def test_ids_are_those_of_whole_texts(make_docs):
    rows = [
        (1, "Don't we'll I'VE 've ''s it's\x85next　wide space"),
        (2, "ΣΑΣ ὈΔΥΣΣΕΎΣ ΟΔΟΣ İstanbul é é ﬁ ½ x²"),
        (3, "<|endoftext|> a<|startoftext|>b \x01 \x01\x01 a\x01b \x1c\x1d x"),
        (4, "1234 56,78 $%&/()= 日本語 текст 🙂🙃 naïve straße \x00 �"),
        (5, " ".join(chr(c) for c in range(0x21, 0x250))),
    ]
    check(packing.packed(make_docs(rows), tokenizer(), 50), rows, 50)


@pytest.mark.parametrize(
    "draw", [lambda r: r.randrange(1, 101), lambda r: 34, lambda r: r.choice([1, 2, 3]), lambda r: r.choice([50, 51, 100]), lambda r: min(100, 1 + int(r.expovariate(0.1)))]
)
def test_nearly_as_few_sequences_as_one_task_finds(spark, draw):
    rng = random.Random(6)
    sizes = [draw(rng) for _ in range(700)]
    state = spark.createDataFrame(list(enumerate(sizes)), "id_ long, size_ long")
    placed = rows_of(packing.best_fit(state, 100))
    assert sorted(r.id_ for r in placed) == list(range(700))
    used = check_sequences([(r.seq_, r.at_, sizes[r.id_]) for r in placed], 100)
    assert used <= 1.06 * best_fit_decreasing(sizes, 100) + 1


@pytest.mark.parametrize("draw", [lambda r: 1, lambda r: r.choice([1] * 50 + [2, 3, 700])])
def test_short_texts_fill_gaps(spark, draw):
    rng = random.Random(8)
    sizes = [draw(rng) for _ in range(60_000)]
    state = spark.createDataFrame(list(enumerate(sizes)), "id_ long, size_ long")
    placed = rows_of(packing.best_fit(state, 2048))
    assert sorted(r.id_ for r in placed) == list(range(60_000))
    used = check_sequences([(r.seq_, r.at_, sizes[r.id_]) for r in placed], 2048)
    # The first sequences are drawn by hash, so that their number errs by its root.
    assert used <= 1.2 * max(-(-sum(sizes) // 2048), -(-sizes.count(700) // 2)) + 4


def test_a_round_pairs_the_largest_piece_that_fits(spark):
    state = spark.createDataFrame(
        [(0, 5, 1), (0, 4, 2), (0, 3, 3), (0, 9, 4), (1, 4, 10), (1, 6, 11), (1, 2, 12)], "kind_ int, size_ int, id_ long"
    )
    for parts in (1, 3):
        got = {r.id_: (r.seq_, r.at_) for r in rows_of(packing.sweep(state, 100, parts)) if r.kind_ == packing.PLACED}
        assert got == {2: (10, 96), 1: (11, 94)}


def test_an_encoder_goes_when_its_process_does_other_work():
    from fieldtrail.llm.store import release

    encoder = packing.encoder_of(tokenizer())
    release("packing")
    assert packing.encoder_of(tokenizer()) is encoder  # the next task of packing finds its words again
    release()
    assert packing.encoder_of(tokenizer()) is not encoder
