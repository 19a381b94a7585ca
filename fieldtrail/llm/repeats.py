"""Periodic runs: stretches of words that repeat with a period, found by enumerating maximal pairs.

The suffixes of a text that begin like another one are sorted, and the tree of their LCP intervals is walked bottom up.
Each interval holds its suffixes by place, each in the class of the word to its left. When two children meet, a suffix
of one and a suffix of the other are a maximal pair if their left words differ: what they share cannot be made longer on
either side. If q is the distance of the two and l the length of what they share, the words from the first on, q + l of
them, have period q and no neighbour continues it. So pairs with q + l >= max(6, 4 q) are the runs, without any further
extension.

With l >= 3 q, the suffixes of one interval near to one another continue one and the same repetition, so that all of
them but the first have the same left word: on each side of a suffix, a single look suffices, and no pair is listed that
is no run. Smaller children are moved into larger ones, which gives n log n moves for n words.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import release

#: What the two suffixes of a run share at least: of length >= max(6, 4 q), q words go to the distance.
LEAST = 5

# Odd multipliers for a hash of five words in a row. It only tells where to look; equality is by rank afterwards.
_MULTIPLIERS = np.random.default_rng(13).integers(1, 1 << 63, LEAST, dtype=np.uint64) | np.uint64(1)


def _numbered(words: list[bytes]) -> np.ndarray:
    """Each word's number; equal words have equal ones."""
    known = dict.fromkeys(words)
    known = dict(zip(known, range(len(known))))
    return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def _repeated(ids: np.ndarray) -> np.ndarray:
    """Places whose five words from there on occur elsewhere too; by hash, so that a few more may be among them."""
    n = len(ids) - LEAST + 1
    if n < 2:
        return np.zeros(0, dtype=np.int64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = sum(mixed[k : n + k] * m for k, m in enumerate(_MULTIPLIERS))
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    return np.sort(order[np.append(same, False) | np.append(False, same)])


def _named(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1)


def sorted_suffixes(ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``places`` in the order of the suffixes there, and how many words each shares with the one before it.

    Stretches of 1, 2, 4, … words are named in order, by pairs of names. Stretches that no other place shares keep
    their name; only places with equal names are looked at again.
    """
    n = len(ids)
    levels = [ids]  # names of the stretches of 2**k words that begin at each place
    width = 1
    # Names of all places are needed, as a stretch may end among places that are not looked at.
    while width < n:
        name = levels[-1]
        later = np.append(name[width:] + 1, np.zeros(width, dtype=np.int64))
        made = _named(name * (n + 1) + later)
        levels.append(made)
        width *= 2
        if len(np.unique(made[places])) == len(places):
            break
    order = places[np.argsort(levels[-1][places], kind="stable")]
    shared = np.zeros(len(order), dtype=np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(a), dtype=np.int64)
    for k in reversed(range(len(levels))):
        size = 1 << k
        fits = np.flatnonzero((a + size <= n) & (b + size <= n))
        equal = fits[levels[k][a[fits]] == levels[k][b[fits]]]
        common[equal] += size
        a[equal] += size
        b[equal] += size
    shared[1:] = common
    return order, shared


def _maximal_pairs(ids: np.ndarray, order: list[int], shared: list[int]) -> Iterator[tuple[int, int, int]]:
    """(first, second, shared words) of the maximal pairs whose distance is at most a third of what they share."""
    left = [-1, *ids.tolist()]  # of each place, its class: the word to its left

    def between(place: int, others: list[int], size: int) -> Iterator[tuple[int, int, int]]:
        reach = size // 3
        k = bisect_left(others, place - reach)
        if k < len(others) and others[k] < place and left[others[k]] != left[place]:
            yield others[k], place, size
        k = bisect_right(others, place)
        if k < len(others) and others[k] - place <= reach and left[others[k]] != left[place]:
            yield place, others[k], size

    # The open intervals, from the root to the deepest: (shared words, places in order).
    open_: list[tuple[int, list[int]]] = []

    def met(one: list[int], other: list[int], size: int) -> Generator[tuple[int, int, int], None, list[int]]:
        if size < LEAST:  # nothing that is nearer to the root can share enough
            return []
        small, large = sorted((one, other), key=len)
        for place in small:
            yield from between(place, large, size)
        for place in small:
            insort(large, place)
        return large

    for i, place in enumerate(order):
        size = shared[i]
        last: list[int] | None = None
        while open_ and open_[-1][0] > size:
            depth, places = open_.pop()
            if last is not None:
                places = yield from met(places, last, depth)
            last = places
        if last is not None:
            if open_ and open_[-1][0] == size:
                depth, places = open_.pop()
                last = yield from met(places, last, size)
            open_.append((size, last))
        # A leaf is deeper than any interval.
        open_.append((len(ids) + 1, [place]))
    last = None
    while open_:
        depth, places = open_.pop()
        if last is not None:
            places = yield from met(places, last, depth)
        last = places


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all runs of a sequence of numbers, in order."""
    places = _repeated(ids)
    if not len(places):
        return []
    order, shared = sorted_suffixes(_named(ids), places)
    found: dict[tuple[int, int], int] = {}
    for a, b, size in _maximal_pairs(ids, order.tolist(), shared.tolist()):
        period = b - a
        length = period + size
        if length >= max(6, 4 * period):
            # Multiples of a period give the same stretch.
            found[a, length] = min(period, found.get((a, length), period))
    return sorted((start, length, period) for (start, length), period in found.items())


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


#: n_runs, and start, length and period of the longest; digests of all runs and of the text without repetitions.
SCHEMA = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
    "collapsed string, runs array<struct<start: long, length: long, period: long>>"
)


def described(text: str | None, whole: bool = True) -> tuple:
    """The columns of ``SCHEMA`` for a text; the last two only if ``whole``."""
    words = (text or "").encode().split()
    runs = runs_of(_numbered(words)) if len(words) > LEAST else []
    best: tuple = (None, None, None, None)
    if runs:
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]))
        best = (start, length, period, 1000 * length // period)
        # Words of a run after its first period go: +1 where they begin, -1 where they end.
        steps = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            steps[start + period] += 1
            steps[start + length] -= 1
        stays = np.cumsum(steps[:-1]) == 0
        words = [w for w, s in zip(words, stays.tolist()) if s]
    collapsed = b" ".join(words)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    digests = (_digest(listed), hashlib.sha256(collapsed).hexdigest())
    return (len(runs), *best, *digests, *((collapsed.decode(), runs) if whole else (None, None)))


def periodic_runs(docs: DataFrame, whole: bool = True) -> DataFrame:
    """One row per document: doc_id and the columns of ``SCHEMA``.

    Words are what stands between ASCII white space. A run is a stretch of words with smallest period q, of at least
    max(6, 4 q) words, which no neighbouring word continues. ``start`` to ``exponent_milli`` tell of the longest run
    (the first of equal ones, then that of the smallest period) and are null without runs. ``collapsed`` has the words
    that no run holds after its first period, joined by one space; ``runs`` has all runs in order. Both digests are of
    UTF-8 and never null. ``whole=False`` leaves these two columns out.

    A null, empty or blank text has no words and no runs. Null and repeated doc_ids each give a row. An empty table
    gives no rows. Other columns are ignored. A text is read whole, by one task, in memory of some hundred bytes a word.
    """
    fields = SCHEMA if whole else SCHEMA.split(", collapsed string")[0]
    names = ["doc_id", *(f.split()[0] for f in fields.split(", ")[: 9 if whole else 7])]
    run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    kinds = [*[pa.int64()] * 5, *[pa.string()] * 3, pa.list_(run)][: len(names) - 1]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 500):  # collapsed texts of some rows only at once
                part = batch.slice(start, 500)
                rows = [described(t.as_py(), whole) for t in part.column(1)]
                columns = [list(c) for c in zip(*rows)][: len(kinds)]
                if whole:
                    columns[-1] = [[dict(zip(("start", "length", "period"), r)) for r in row] for row in columns[-1]]
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, columns, kinds)], names)
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(describe, f"doc_id long, {fields}")
