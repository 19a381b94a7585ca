"""Near-duplicates by SuperMinHash: signatures, banding, verification on full sets, groups.

SuperMinHash gives each shingle a random permutation of the signature's places; a shingle's value at a place is its rank
there plus a random fraction, and a place keeps the least value. The ranks of one shingle are correlated (a permutation
gives each place another rank), which makes estimates less scattered than those of independent hashes. Ranks are dealt
level by level for all shingles of a text at once, and as a value of a level is below all of the next one, it stops at
the level that fills the last place: after one or two for all but short texts.

Texts that agree on a band of places are candidates. Text with text in one bucket would be too many, so candidates are
looked at in rounds: each text of a bucket is compared with a chosen one of its part of the bucket, and the chosen ones
with one another's first; groups are formed; and only texts whose groups still differ within a bucket go on. In the end,
all texts of a bucket that are not of its largest group are compared with all others, within tasks, and only links that
join groups come out.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .store import discard, keep, release

#: Bands, and places of each. Texts with a similarity of 0.85 share no band with a chance below 1 in 2,000,000.
BANDS, ROWS = 20, 4
PLACES = BANDS * ROWS
#: Parts of a bucket in a round; rounds; shingles of a bucket that one task compares with as many others in the end.
PARTS, ROUNDS, BLOCK = 64, 2, 1_000_000

_GOLDEN = 0x9E3779B97F4A7C15


def shingles(text: str | None, width: int = 3) -> set[tuple[bytes, ...]]:
    """Distinct runs of ``width`` lower-cased (A-Z) words; all words as one if they are fewer; none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return set(zip(*(words[i:] for i in range(width)))) if len(words) >= width else {tuple(words)}


def hashes_of(distinct: set[tuple[bytes, ...]]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), 42) for s in distinct), np.uint64, len(distinct))


def _random(hashes: np.ndarray, level: int) -> np.ndarray:
    """A number for each hash and level (the finaliser of a splittable generator)."""
    x = hashes + np.uint64((level + 1) * _GOLDEN & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signature(hashes: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Least rank (upper bits) with fraction (lower 44 bits) at each place, of the ``hashes`` of distinct shingles."""
    best = np.full(places, np.iinfo(np.int64).max, dtype=np.int64)
    moved = None
    rows = np.arange(len(hashes))
    for level in range(places if len(hashes) else 0):
        x = _random(hashes, level)
        swap = level + (x % np.uint64(places - level)).astype(np.int64)
        if moved is None and level:
            # The permutations so far: only the first swap is done.
            moved = np.tile(np.arange(places, dtype=np.int16), (len(hashes), 1))
            moved[rows, 0], moved[rows, first] = first, 0  # noqa: F821
        if moved is None:
            first = chosen = swap
        else:
            chosen = moved[rows, swap].astype(np.int64)
            moved[rows, swap] = moved[rows, level]
        values = (np.int64(level) << np.int64(44)) | (x >> np.uint64(20)).astype(np.int64)
        np.minimum.at(best, chosen, values)
        # All values of later levels are above: nothing changes any more once every place has one.
        if best.max() < (level + 1) << 44:
            break
    return best


def band_keys(values: np.ndarray) -> list[int]:
    """One number per band."""
    rows = values.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), k) - (1 << 63) for k, row in enumerate(rows)]


SKETCH = T.StructType(
    [
        T.StructField("words", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]
)


def sketch(column, width: int):
    """Of a text column: a digest of its words, the size of its set, and a number per band (none without words)."""
    kinds = {"words": pa.binary(), "n": pa.int64(), "keys": pa.list_(pa.int64())}

    @F.arrow_udf(SKETCH)
    def made(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            text = text.as_py()
            distinct = shingles(text, width)
            values = signature(hashes_of(distinct))
            # Which words there are, whatever stands between them.
            words = hashlib.sha256(b" ".join((text or "").encode().lower().split())).digest()
            rows.append((words, len(distinct), band_keys(values) if distinct else []))
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))

    return made(column)


def _fits(a, b, percent: int):
    """Whether sets of these sizes can be so similar."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a_", "b_").alias("a_"), F.least("a_", "b_").alias("b_")).where("a_ <> b_").distinct()


def _with_chosen(own: DataFrame, turn: int, percent: int) -> DataFrame:
    """a_, b_: each row with a chosen one of its part of the bucket, and the chosen ones of the parts with the bucket's,
    if their groups differ and sizes allow. ``own`` has key_, row_, group_, n_. No task has a whole bucket."""
    order = F.struct(F.xxhash64(F.lit(turn), "row_").alias("order_"), "row_", "group_", "n_")
    own = own.withColumn("part_", F.pmod(F.xxhash64("row_"), F.lit(PARTS)).cast("int"))
    parts = own.groupBy("key_", "part_").agg(F.min(order).alias("one_"), F.count("*").alias("rows_"))
    whole = parts.groupBy("key_").agg(F.min("one_").alias("top_"))
    low = own.join(parts.where("rows_ > 1").select("key_", "part_", "one_"), ["key_", "part_"])
    high = parts.join(whole, "key_").select("one_.row_", "one_.group_", "one_.n_", F.col("top_").alias("one_"))
    both = low.select("row_", "group_", "n_", "one_").unionByName(high)
    both = both.where((F.col("group_") != F.col("one_.group_")) & _fits(F.col("n_"), F.col("one_.n_"), percent))
    return _ordered(both.select(F.col("row_").alias("a_"), F.col("one_.row_").alias("b_")))


def links_between(left: list[tuple], right: list[tuple], percent: int) -> Iterator[tuple[int, int]]:
    """Links of rows (row, group, hashes of the set) of ``left`` with those of ``right`` that join all groups which any
    link joins: a forest, not all links. An index of the right side counts what a set shares with all others at once."""
    flat = np.concatenate([r[2] for r in right])
    sizes = np.array([len(r[2]) for r in right])
    names, codes = np.unique(flat, return_inverse=True)
    order = np.argsort(codes, kind="stable")
    holders = np.repeat(np.arange(len(right)), sizes)[order]
    starts = np.searchsorted(codes[order], np.arange(len(names) + 1))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for row, group, hashes in left:
        at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
        at = at[names[at] == hashes]
        shared = np.zeros(len(right), dtype=np.int64)
        for k in at.tolist():
            shared[holders[starts[k] : starts[k + 1]]] += 1
        for k in np.flatnonzero(100 * shared >= percent * (len(hashes) + sizes - shared)).tolist():
            one, other = find(group), find(right[k][1])
            if one != other:
                root[one] = other
                yield row, right[k][0]


def _rest(open_: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """a_, b_: links in buckets of several groups, of the rows outside of a bucket's largest group with all its rows.

    Sets are compared where they are, as hashes, and only links that join groups come out. The rows of a bucket are
    dealt into blocks by the size of their sets, so that a task has about BLOCK hashes on either side, or one set.
    """
    sizes = open_.groupBy("key_", "group_").agg(F.sum("n_").alias("size_"))
    most = sizes.groupBy("key_").agg(F.max(F.struct("size_", "group_")).alias("top_"), F.sum("size_").alias("all_"))
    most = most.select(
        "key_",
        F.col("top_.group_").alias("main_"),
        F.ceil(F.col("all_") / BLOCK).cast("int").alias("blocks_"),
        F.ceil((F.col("all_") - F.col("top_.size_")) / BLOCK).cast("int").alias("others_"),
    )
    rows = open_.join(most, "key_").withColumn("other_", F.col("group_") != F.col("main_"))

    @F.arrow_udf("array<long>")
    def hashed(column: pa.Array) -> pa.Array:
        return pa.array([hashes_of(shingles(t.as_py(), width)).view(np.int64) for t in column], pa.list_(pa.int64()))

    sets = keep(texts.join(open_.select("row_").distinct(), "row_", "left_semi").select("row_", hashed(F.col("text")).alias("set_")))
    deal = lambda n: F.pmod(F.xxhash64("row_"), F.col(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["key_", "row_", "group_"]
    left = rows.where("other_").select(*columns, F.lit(True).alias("left_"), deal("others_").alias("i_"), copies("blocks_").alias("j_"))
    right = rows.select(*columns, F.lit(False).alias("left_"), copies("others_").alias("i_"), deal("blocks_").alias("j_"))

    def run(table: pa.Table) -> pa.Table:
        sides: tuple[list, list] = ([], [])
        sets_ = (np.array(x, dtype=np.int64) for x in table.column("set_").to_pylist())
        for row, group, is_left, own in zip(*(table.column(c).to_pylist() for c in ("row_", "group_", "left_")), sets_):
            sides[0 if is_left else 1].append((row, group, own))
        found = list(links_between(*sides, percent)) if sides[0] and sides[1] else []
        return pa.table({"a_": pa.array([a for a, _ in found], pa.int64()), "b_": pa.array([b for _, b in found], pa.int64())})

    return left.unionByName(right).join(sets, "row_").groupBy("key_", "i_", "j_").applyInArrow(run, "a_ long, b_ long")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The ``pairs`` whose full sets are similar. ``texts`` has row_ and text."""
    chosen = pairs.select(F.col("a_").alias("row_")).union(pairs.select("b_")).distinct()
    bodies = keep(texts.join(chosen, "row_", "left_semi"))
    side = lambda s: bodies.select(F.col("row_").alias(f"{s}_"), F.col("text").alias(f"text_{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            good = []
            for key, a, b in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if key != last:  # chosen ones come many times in a row
                    last, own = key, shingles(b.as_py(), width)
                other = shingles(a.as_py(), width)
                common = len(own & other)
                good.append(100 * common >= percent * (len(own) + len(other) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a_", "b_"]).filter(pa.array(good, pa.bool_()))
        release()

    both = pairs.join(side("a"), "a_").join(side("b"), "b_").select("a_", "b_", "text_a", "text_b")
    links = keep(both.mapInArrow(run, "a_ long, b_ long"))
    discard(bodies)
    return links


def near_groups(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles (distinct), component_id (smallest doc_id linked, itself included), kept.

    Two documents link if 100 times the shingles they share is ``percent`` times those of either or more; groups follow
    links. A document of fewer words than a shingle has all of them as its only one; one without words has none and is
    linked with nothing. A null doc_id is in its group but never names it, unless all are null (then it is kept, as
    documents without words are). Repeated rows each give a row. An empty table gives no rows. Other columns are
    ignored. Texts are read whole; a task has the sets of two texts at once.
    """
    # Rows are numbered, as ids may repeat, and written with their texts, so that the numbers stay.
    made = docs.select(F.col("doc_id").cast("long"), "text", sketch(F.col("text"), width).alias("s_"))
    made = keep(made.withColumn("row_", F.monotonically_increasing_id()))
    made = made.select("doc_id", "row_", "text", F.col("s_.words").alias("words_"), F.col("s_.n").alias("n_"), "s_.keys")
    # Texts of the same words are one from here on.
    least = keep(made.where("n_ > 0").groupBy("words_").agg(F.min("row_").alias("row_")))
    of_texts = made.join(least.select("row_"), "row_", "left_semi")
    bands = keep(of_texts.select("row_", "n_", F.explode("keys").alias("key_")))
    counts = bands.groupBy("key_").agg(F.count("*").alias("rows_")).where("rows_ > 1").select("key_")
    own = keep(bands.join(counts, "key_"))  # a bucket of one text needs no more
    met = own.select("row_").distinct()
    texts = keep(made.select("row_", "text").join(met, "row_", "left_semi"))
    group, links, tried = own.select("row_", F.col("row_").alias("group_")).distinct(), [], []
    for turn in range(ROUNDS + 1):
        named = own.join(group, "row_")
        several = named.groupBy("key_").agg(F.min("group_").alias("low_"), F.max("group_").alias("high_"), F.count("*").alias("rows_"))
        # The two texts of a bucket of two have met in the first round.
        several = several.where("low_ < high_").where(F.col("rows_") > (2 if turn else 1)).select("key_")
        open_ = keep(named.join(several, "key_"))
        if open_.isEmpty():
            break
        pairs = _with_chosen(open_, turn, percent) if turn < ROUNDS else _ordered(_rest(open_, texts, width, percent))
        for before in tried:
            pairs = pairs.join(before, ["a_", "b_"], "left_anti")
        tried.append(keep(pairs))
        links.append(_verified(tried[-1], texts, width, percent))
        linked = components(functools.reduce(DataFrame.unionByName, links)).withColumnRenamed("node_", "row_")
        group = keep(met.join(linked, "row_", "left").select("row_", F.coalesce("component_", "row_").alias("group_")))
    # From texts to documents, and from numbers to ids.
    root = least.join(group, "row_", "left").select("words_", F.coalesce("group_", "row_").alias("root_"))
    rows = made.select("doc_id", "words_", F.col("n_").alias("n_shingles"))
    worded = keep(rows.where("n_shingles > 0").join(root, "words_").select("doc_id", "n_shingles", "root_"))
    names = worded.groupBy("root_").agg(F.min("doc_id").alias("component_id"))
    linked = worded.join(names, "root_").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
