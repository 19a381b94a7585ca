"""Spelling variants: words that differ in one letter, found by pivotal grams.

The bigrams of a word are ordered by how rare they are among all words; its first three are its prefix. Of these, two
that do not overlap are its pivots. One edit spoils one pivot at most, so of two near words, the pivots of the one whose
prefix ends first have one that the other's prefix holds too. It stands at the same distance from the beginning of both
words, with all letters before it equal, or from the end, with all letters after it: an edit is on one side only. So
postings carry the part of the word up to the gram, or from it on, and pivots meet prefixes of equal parts. What remains
of the two words is then compared: it must be one edit apart.

Words that share a part are compared in one task, by what stays of the rest if a piece of it is left out. A part that
very many words share is dealt to tasks by these pieces instead.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import keep, release

#: Letters of a gram, grams of a prefix (for one edit), and letters of the shortest word that has so many.
GRAM, PREFIX, SHORTEST = 2, 3, 4
#: One edit makes two new grams at most. So many occurrences of the last gram of a prefix may matter to another word.
OCCURRENCES = PREFIX + 2
#: Counters of grams, which share a counter by hash if there are more of them: the order only has to be the same for all.
CELLS = 1 << 16
#: Pieces that the rest of a word is cut into, and postings of one part that a task takes together.
PIECES, TOGETHER = 8, 50_000
#: Pairs that are compared without an index.
FEW = 40

PREFIXED, FIRST, SECOND = 0, 1, 2  # what a posting's gram is to its word: in the prefix only, or one of its pivots


def word_counts(
    docs: DataFrame,
    least_letters: int = 7,
    least_count: int = 2,
    change: Callable[[int | None, str], str] | None = None,
) -> DataFrame:
    """word and n: maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts, A-Z lower-cased, and how often
    each occurs. ``change``, given a doc_id and a run, may return another word for the run in that document."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_letters},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Bytes are lower-cased within ASCII only.
                found = Counter(runs.findall((text.as_py() or "").encode().lower().decode()))
                if change is not None:
                    changed: Counter = Counter()
                    for word, n in found.items():
                        changed[change(id_, word)] += n
                    found = changed
                counts.update(found)
            counts = {w: n for w, n in counts.items() if len(w) >= least_letters}
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        release()

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def grams_of(word: str) -> list[str]:
    return [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]


def _cell(gram: str) -> int:
    return zlib.crc32(gram.encode()) % CELLS


def gram_ranks(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per cell: how many grams of ``words`` fall into it, and its place in the order by that number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(g for w in batch.column(0).to_pylist() for g in grams_of(w))
            cells: Counter = Counter()
            for gram, n in counts.items():
                cells[_cell(gram)] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(cells), pa.int32()), pa.array(list(cells.values()), pa.int64())], ["cell", "n"])

    sums = words.select("word").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(CELLS, dtype=np.int64)
    for row in sums.collect():  # as many rows as cells
        counts[row["cell"]] = row["n"]
    ranks = np.empty(CELLS, dtype=np.int64)
    ranks[np.lexsort((np.arange(CELLS), counts))] = np.arange(CELLS)
    return counts, ranks


def pivots(prefix: list[tuple[int, int]], wanted: int = 2) -> list[int]:
    """Places of ``wanted`` grams of ``prefix`` (place, weight) that do not overlap, of least weight together.

    Dynamic programming over the places: the best choice of k grams that ends with a certain one adds it to the best
    choice of k - 1 that ends far enough before it.
    """
    grams = sorted(prefix)
    best: list[tuple[int, list[int]] | None] = [(w, [at]) for at, w in grams]
    for _ in range(wanted - 1):
        longer: list[tuple[int, list[int]] | None] = []
        for k, (at, weight) in enumerate(grams):
            before = [b for b, (other, _) in zip(best[:k], grams) if b is not None and other + GRAM <= at]
            cost, places = min(before, default=(0, None))
            longer.append(None if places is None else (cost + weight, [*places, at]))
        best = longer
    return min(b for b in best if b is not None)[1]


class Grams:
    """The order of grams, and the prefix and pivots of a word by it."""

    def __init__(self, counts: np.ndarray, ranks: np.ndarray) -> None:
        self.counts, self.ranks = counts, ranks
        self.known: dict[str, tuple[int, int]] = {}  # rank, unlike for any two grams, and weight

    def learn(self, word: str) -> None:
        if len(self.known) > CELLS:
            self.known = {}
        for gram in grams_of(word):
            cell = _cell(gram)
            rank = int(self.ranks[cell]) << 42 | ord(gram[0]) << 21 | ord(gram[1])
            self.known[gram] = (rank, int(self.counts[cell]))

    def of(self, word: str) -> tuple[int, list[int], list[int]]:
        """Rank of the last gram of the prefix; places of the pivots; places of all grams up to that last one."""
        grams = grams_of(word)
        if not self.known.keys() >= set(grams):
            self.learn(word)
        known = self.known
        order = sorted([(known[g], at) for at, g in enumerate(grams)])
        first = order[:PREFIX]
        last = first[-1][0][0]
        chosen = pivots([(at, weight) for (_, weight), at in first])
        places = [at for (rank, _), at in first if rank < last]
        places += [at for (rank, _), at in order[len(places) : len(places) + OCCURRENCES] if rank == last]
        return last, chosen, places


def postings(words: DataFrame, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """key_ (of a part of the word), at_ (place of the gram, -1 - place if the part is what follows), role_, last_,
    other_ (place of the first pivot), word, n."""
    sent = words.sparkSession.sparkContext.broadcast(order)
    names = ["key_", "at_", "role_", "last_", "other_", "word", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(*sent.value)
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], [], []]
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                last, (one, two), places = grams.of(word)
                for at in places:
                    role = FIRST if at == one else SECOND if at == two else PREFIXED
                    parts = ((xxhash.xxh64_intdigest(word[: at + GRAM], 1), at), (xxhash.xxh64_intdigest(word[at:], 2), -1 - at))
                    for key, place in parts:
                        for column, value in zip(columns, (key - (1 << 63), place, role, last, one, word, n)):
                            column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int8(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names)

    schema = "key_ long, at_ int, role_ byte, last_ long, other_ int, word string, n long"
    return words.select("word", "n").mapInArrow(run, schema)


def one_edit(a: str, b: str) -> bool:
    """Whether the texts differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def rest_of(word: str, at: int) -> str:
    """What is left of a word without the part of a posting, beginning where the part ends."""
    return word[at + GRAM :] if at >= 0 else word[: -1 - at][::-1]


@functools.lru_cache(maxsize=4096)
def cuts(size: int) -> list[tuple[int, int]]:
    """Where the pieces of a rest of this size begin and end."""
    pieces = min(PIECES, max(size, 1))
    return [(size * k // pieces, size * (k + 1) // pieces) for k in range(pieces)]


def without_pieces(rest: str, size: int) -> list[tuple[str, str]]:
    """What stays of ``rest`` before and after each piece of a rest of ``size``. Rests that are one edit apart have one
    of these in common, for the size of either."""
    more = len(rest) - size
    return [(rest[:start], rest[end + more :]) for start, end in cuts(size)]


Posting = tuple[int, int, int, int, str, int]  # at_, role_, last_, other_, word, n


def is_pair(a: Posting, b: Posting) -> bool:
    """Whether a's pivot and b's prefix give a pair of near words that no other posting gives.

    The pivots that count are those of the word whose prefix ends first, and of two that both survive the edit, the
    first one.
    """
    at, role, last, other, word, _ = a
    if (last, word) >= (b[2], b[4]) or not one_edit(rest_of(word, at), rest_of(b[4], b[0])):
        return False
    if role == FIRST:
        return True
    its = b[4]
    return word[: other + GRAM] != its[: other + GRAM] and not its.endswith(word[other:])


def near_in(group: list[Posting]) -> Iterator[tuple[Posting, Posting]]:
    """The pairs within the postings of one part."""
    own = [p for p in group if p[1] != PREFIXED]
    if not own:
        return
    if len(own) * len(group) <= FEW:
        yield from ((a, b) for a in own for b in group if is_pair(a, b))
        return
    # What stays of the rests with a pivot, by their size; all rests are looked up there, by their neighbours' sizes too.
    index: dict[int, dict] = {}
    for a in own:
        rest = rest_of(a[4], a[0])
        by_size = index.setdefault(len(rest), {})
        for key in without_pieces(rest, len(rest)):
            by_size.setdefault(key, []).append(a)
    for b in group:
        rest = rest_of(b[4], b[0])
        found = {}
        for size in (len(rest) - 1, len(rest), len(rest) + 1):
            by_size = index.get(size)
            if by_size is not None:
                for key in without_pieces(rest, size):
                    for a in by_size.get(key, ()):
                        found[a[4]] = a
        for a in found.values():
            if is_pair(a, b):
                yield a, b


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Posting]]:
    """Postings of one key_ each, of two rows at least, from batches in the order of key_."""
    last, held = None, []
    for batch in batches:
        keys = batch.column(0).to_numpy()
        if not len(keys):
            continue
        # Only rows beside one of the same key are looked at, and the last ones, which may go on in the next batch.
        same = np.append(keys[1:] == keys[:-1], True)
        chosen = np.flatnonzero(same | np.append(True, same[:-1]))
        rows = zip(*(batch.column(i).take(pa.array(chosen)).to_pylist() for i in range(batch.num_columns)))
        for key, *posting in rows:
            if key != last:
                if len(held) > 1:
                    yield held
                last, held = key, []
            held.append(tuple(posting))
    if len(held) > 1:
        yield held


_PAIRS = "word string, its string, its_n long"


def _pairs_within(rows: DataFrame) -> DataFrame:
    """word, its, its_n: both directions of each pair found among the rows (postings) of one key_."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], []]

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(list(map(pa.array, columns, (pa.string(), pa.string(), pa.int64()))), ["word", "its", "its_n"])
            for column in columns:
                column.clear()
            return made

        for group in _groups(batches):
            for a, b in near_in(group):
                for column, values in zip(columns, ((a[4], b[4]), (b[4], a[4]), (b[5], a[5]))):
                    column.extend(values)
            if len(columns[0]) >= 20_000:
                yield out()
        yield out()
        release()

    columns = ["key_", "at_", "role_", "last_", "other_", "word", "n"]
    return rows.select(*columns).repartition("key_").sortWithinPartitions("key_").mapInArrow(run, _PAIRS)


def _by_pieces(rows: DataFrame) -> DataFrame:
    """Postings again, of parts that very many words share: a key_ for each piece that may be left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 2000):
                some = batch.slice(start, 2000)
                keys, at = [], []
                columns = (some.column(i).to_pylist() for i in (0, 1, 2, 5))
                for k, (key, place, role, word) in enumerate(zip(*columns)):
                    rest = rest_of(word, place)
                    for size in (len(rest) - 1, len(rest), len(rest) + 1):
                        for piece in without_pieces(rest, size) if size >= 0 else ():
                            keys.append(xxhash.xxh64_intdigest(repr((key, size, piece)).encode()) - (1 << 63))
                            at.append(k)
                again = some.take(pa.array(at, pa.int64())).columns[1:]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *again], some.schema.names)

    return rows.mapInArrow(run, rows.schema)


def near_words(words: DataFrame) -> DataFrame:
    """word, its, its_n: each word of ``words`` (word, n; distinct, of four letters or more) with each near word."""
    listed = keep(postings(words, gram_ranks(words)))
    busy = listed.groupBy("key_").agg(F.count("*").alias("rows_")).where(F.col("rows_") > TOGETHER).select("key_")
    busy = keep(busy)
    usual = _pairs_within(listed.join(busy, "key_", "left_anti"))
    hot = _pairs_within(_by_pieces(listed.join(busy, "key_").select(*listed.columns)))
    # A word of m letters has some 200 * m near words at most in an alphabet of 90 letters.
    return usual.unionByName(hot).repartition("word").dropDuplicates(["word", "its"])


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n; distinct words of four letters or more).

    Words are near if they differ by exactly one inserted, deleted or replaced code point. The form is the near word of
    largest n (of equal ones the first in code-point order), if its n is ``ratio`` times the word's or more. The root is
    found by following forms; without a form it is the word itself. An empty table gives no rows.
    """
    words = keep(words.select("word", F.col("n").cast("long").alias("n")).where(F.char_length("word") >= SHORTEST))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("its_n")).alias("n"), "its")).alias("most_"))
    made = words.join(near, "word", "left").withColumn("form_n", F.when(-F.col("most_.n") >= ratio * F.col("n"), -F.col("most_.n")))
    made = keep(made.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("form_n").isNotNull(), F.col("most_.its")).alias("form"), "form_n"))
    # Along forms, n grows tenfold, so that paths are short; each step doubles how far they are followed.
    up = made.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next_"))
        jumped = keep(up.join(further, "root", "left").select("word", F.coalesce("next_", "root").alias("root"), F.col("next_").isNotNull().alias("moved_")))
        up = jumped.select("word", "root")
        if jumped.where("moved_").isEmpty():
            break
    return made.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, change: Callable[[int | None, str], str] | None = None) -> DataFrame:
    """``variants`` of the words of ``docs`` that have seven letters and occur twice at least.

    Null and blank texts have no words. Repeated rows count again. Null doc_ids are read like others. An empty table
    gives no rows. Other columns are ignored. A text is read whole by one task, a long word is one word.
    """
    return variants(word_counts(docs, change=change))
