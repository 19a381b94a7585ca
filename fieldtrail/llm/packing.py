"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

Pieces and gaps are put in one order by size. A sweep over it pairs each gap with the largest free piece that fits, as
opening and closing brackets pair: pieces open, gaps close, and partners have the same depth. Depths come from counts
of equal sizes, so the sweep is a count, a running sum over sizes, and a look at the successor within a depth; pieces
that want the same gaps are told apart by their rank. All pairs of a round are placed at once, gaps shrink, and the next
round begins. Pieces larger than every gap get new sequences, as many to one as fit. When pieces are far more than gaps, a gap
takes as many pieces of one size as fit in one round.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import REMEMBERED, keep, portions, release

#: Words whose ids a Python process remembers, about.
WORDS = 1_200_000
#: Rows of one size that one task ranks, about.
CELL_ROWS = 100_000
#: Parts of one size, at most; with the sizes, this bounds the table of counts.
MOST_CELLS = 256

PIECE, GAP, PLACED = 0, 1, 2


def forget(memory: dict, most: int) -> None:
    """Drop the older half of a memory that has grown too large."""
    if len(memory) > most:
        for key in list(itertools.islice(memory, len(memory) // 2)):
            del memory[key]


class Encoder:
    """Token ids of texts by a tokenizer that drops white space, so that words are encoded apart and remembered.

    Words between ASCII white space are encoded many at once, with a mark between them. ``plain`` says that the
    tokenizer's normalisation of Latin letters is lower case and composing only, and that a token never has both letters
    and the punctuation after them: then texts are lower-cased first, and punctuation after letters is a word of its own,
    so that there are fewer words to remember.
    """

    MARK = "\x01"
    # An apostrophe may start a token together with letters.
    SIGN, LATIN = rb"[!-&(-/:-@\[-`{-~]", rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
    TAIL = re.compile(SIGN + rb"(?:(?<=[a-z]" + SIGN + rb")|(?<=" + LATIN + SIGN + rb"))")

    def __init__(self, definition: str, plain: bool = True) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers

        self.full = Tokenizer.from_str(definition)
        self.bare = Tokenizer.from_str(definition)
        self.bare.model = self.full.model  # one vocabulary in memory, not two
        self.plain = plain
        if plain:
            self.bare.normalizer = normalizers.Sequence([])
        (self.mark,) = self.full.encode(self.MARK, add_special_tokens=False).ids
        self.known: dict[bytes, bytes] = {}

    def _encode(self, words: list[str], tokenizer) -> Iterator[bytes]:
        for i in range(0, len(words), 2000):
            joined = f" {self.MARK} ".join(words[i : i + 2000])
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            flat, start = ids.tobytes(), 0
            for mark in [*np.flatnonzero(ids == self.mark).tolist(), len(ids)]:
                yield flat[4 * start : 4 * mark]
                start = mark + 1

    def learn(self, words: Iterable[bytes]) -> None:
        """Encode words that are not known yet."""
        simple, other = [], []
        for word in words:
            text = word.decode()
            if self.MARK in text or "<|" in text:  # a text may spell out a special token, or the mark
                ids = self.full.encode(text, add_special_tokens=False).ids
                self.known[word] = np.array(ids, dtype="<u4").tobytes()
            elif self.plain and (word.isascii() or max(text) <= "\xff"):
                simple.append((word, text.lower()))
            else:
                other.append((word, text))
        for pairs, tokenizer in ((simple, self.bare), (other, self.full)):
            self.known.update(zip((w for w, _ in pairs), self._encode([t for _, t in pairs], tokenizer)))

    def split(self, text: str | None) -> list[bytes]:
        whole = (text or "").encode()
        if self.plain and b"<|" not in whole:
            whole = self.TAIL.sub(rb" \g<0>", whole.lower())
        return whole.split()

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        forget(self.known, WORDS)
        split = [self.split(t) for t in texts]
        found = [list(map(self.known.get, words)) for words in split]
        new = {w for words, ids in zip(split, found) if None in ids for w, known in zip(words, ids) if known is None}
        self.learn(new)
        for words, ids in zip(split, found):
            yield b"".join([self.known[w] if x is None else x for w, x in zip(words, ids)] if None in ids else ids)


#: The encoder of this process. Spark's Python processes run many tasks, and the words of one are met by the next.
_ENCODERS: dict[int, Encoder] = REMEMBERED.setdefault("packing", {})


def encoder_of(definition: str) -> Encoder:
    key = zlib.crc32(definition.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each document's ids and a closing 0, cut at ``capacity``.

    ``tokenizer`` is the definition itself (JSON), which is sent to the tasks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(sent.value)
        step = 4 * capacity
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            encoded = (ids for portion in portions(batch.column(1)) for ids in encoder.ids(portion))
            for id_, ids in zip(batch.column(0).to_pylist(), encoded):
                ids += bytes(4)
                for k, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at : at + step]
                    values = (id_, k, k * capacity, len(cut) // 4, zlib.crc32(cut), cut if with_ids else None)
                    for column, value in zip(rows, values):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, rows, kinds)), names)
        release("packing")

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    names = [c.split()[0] for c in schema.split(", ")]
    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
    return made if with_ids else made.drop("ids")


def _cells(rows: DataFrame, keys: list[str], parts: int, order: list, value, within: list[str]) -> DataFrame:
    """``rows`` with ``rank_``, their number within a cell (keys and a part), and ``before_``, the sum of ``value`` of the
    cells before theirs. Cells are few: the keys are sizes."""
    rows = rows.withColumn("part_", F.pmod(F.xxhash64("id_"), F.lit(parts)).cast("int"))
    cell = [*keys, "part_"]
    running = Window.partitionBy(*within).orderBy(*order, "part_").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*cell).agg(F.count("*").alias("n_"))
    before = counts.select(*cell, F.coalesce(F.sum(value).over(running), F.lit(0)).alias("before_"))
    return rows.withColumn("rank_", F.row_number().over(Window.partitionBy(*cell).orderBy("id_"))).join(before, cell)


def sweep(state: DataFrame, capacity: int, parts: int) -> DataFrame:
    """One round. ``state`` has kind_ (PIECE or GAP), size_ and id_ (of the piece, or of the gap's sequence).

    Returns the new state, and a row PLACED for each piece that found a gap, with seq_ and at_ (its place there).
    """
    opens = F.col("kind_") == PIECE
    signed = F.when(opens, F.col("n_")).otherwise(-F.col("n_"))
    ranked = _cells(state, ["size_", "kind_"], parts, ["size_", "kind_"], signed, [])
    depth = F.when(opens, F.col("before_") + F.col("rank_")).otherwise(F.col("before_") - F.col("rank_") + 1)
    # Along one depth, pieces and gaps take turns. There are twice as many of them as there are sizes, at most.
    along = Window.partitionBy("depth_").orderBy("size_", "kind_", "part_", "rank_")
    seen = ranked.withColumn("depth_", depth).select(
        "kind_",
        "size_",
        "id_",
        F.lead(F.struct("kind_", "size_", "id_")).over(along).alias("next_"),
        F.lag(F.struct("kind_", "size_", "id_")).over(along).alias("last_"),
    )
    found = opens & (F.col("next_.kind_") == GAP)
    filled = (F.col("kind_") == GAP) & (F.col("last_.kind_") == PIECE)
    return seen.select(
        F.when(found, F.lit(PLACED)).otherwise(F.col("kind_")).alias("kind_"),
        F.when(filled, F.col("size_") - F.col("last_.size_")).otherwise(F.col("size_")).alias("size_"),
        "id_",
        F.when(found, F.col("next_.id_")).alias("seq_"),
        F.when(found, capacity - F.col("next_.size_")).alias("at_"),
    ).where("kind_ <> 1 or size_ > 0")


def opened(rows: DataFrame, capacity: int, parts: int) -> DataFrame:
    """New sequences for pieces: those of which k fit by size alone go k to one; what is left of it is a gap."""
    classed = rows.withColumn("fit_", F.expr(f"{capacity} div size_"))
    ranked = _cells(classed, ["fit_", "size_"], parts, [F.desc("size_")], F.col("n_"), ["fit_"])
    number = F.col("before_") + F.col("rank_") - 1
    one = Window.partitionBy("fit_", "bin_").orderBy("place_")
    all_ = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = ranked.withColumns({"bin_": F.floor(number / F.col("fit_")), "place_": number % F.col("fit_")}).select(
        "id_",
        "size_",
        "place_",
        F.first("id_").over(one).alias("seq_"),
        (F.sum("size_").over(one) - F.col("size_")).alias("at_"),
        F.sum("size_").over(all_).alias("full_"),
    )
    placed = seen.select(F.lit(PLACED).alias("kind_"), F.col("size_"), "id_", "seq_", F.col("at_").cast("int"))
    none = F.lit(None)
    gaps = seen.where(f"place_ = 0 and full_ < {capacity}").select(
        F.lit(GAP).alias("kind_"),
        (capacity - F.col("full_")).cast("int").alias("size_"),
        "id_",
        none.cast("long").alias("seq_"),
        none.cast("int").alias("at_"),
    )
    return placed.unionByName(gaps)


def fill_plan(pieces: dict[int, int], gaps: dict[int, int]) -> list[tuple[int, int, int, int, int, int, int]]:
    """Gaps for many small pieces, given how many have each size: (piece size, first piece, pieces, gap size, first gap,
    gaps, pieces of a gap), pieces and gaps numbered within their size. Large pieces go to large gaps, and each gap
    takes as many pieces of one size as fit."""
    plan, room = [], [[size, 0, n] for size, n in sorted(gaps.items(), reverse=True)]
    for size in sorted(pieces, reverse=True):
        first, left = 0, pieces[size]
        while left and room and room[0][0] >= size:
            gap, start, n = room[0]
            each = gap // size
            used = min(n, -(-left // each))
            taken = min(left, used * each)
            plan.append((size, first, taken, gap, start, used, each))
            first, left = first + taken, left - taken
            room[0][1:] = start + used, n - used
            if used == n:
                room.pop(0)
    return plan


def fill(state: DataFrame, capacity: int, parts: int) -> DataFrame:
    """One round for far more pieces than gaps: the new state and PLACED rows as ``sweep`` gives them."""
    counted: dict[int, dict[int, int]] = {PIECE: {}, GAP: {}}
    for r in state.groupBy("kind_", "size_").agg(F.count("*").alias("n")).collect():  # as many rows as sizes
        counted[r["kind_"]][r["size_"]] = r["n"]
    plan = list(enumerate(fill_plan(counted[PIECE], counted[GAP])))
    ranked = _cells(state, ["kind_", "size_"], parts, [], F.col("n_"), ["kind_", "size_"])
    ranked = ranked.select("kind_", "size_", "id_", (F.col("before_") + F.col("rank_") - 1).alias("number_"))
    spark = state.sparkSession
    rows = [(PIECE, p[0], p[1], p[1] + p[2], i, p[6]) for i, p in plan] + [(GAP, p[3], p[4], p[4] + p[5], i, 1) for i, p in plan]
    # A step ends with a size of pieces or with one of gaps, so there are fewer steps than sizes of both.
    steps = spark.createDataFrame(rows, "kind_ int, size_ int, from_ long, to_ long, step_ int, each_ long")
    within = (F.col("number_") >= F.col("from_")) & (F.col("number_") < F.col("to_"))
    dealt = ranked.join(F.broadcast(steps), ["kind_", "size_"]).where(within).withColumn("offset_", F.col("number_") - F.col("from_"))
    ones = dealt.where(F.col("kind_") == PIECE).select(
        "step_",
        F.floor(F.col("offset_") / F.col("each_")).alias("gap_"),
        (F.col("offset_") % F.col("each_")).alias("place_"),
        "size_",
        "id_",
    )
    gaps = dealt.where(F.col("kind_") == GAP).select(
        "step_", F.col("offset_").alias("gap_"), F.col("size_").alias("room_"), F.col("id_").alias("seq_")
    )
    met = keep(ones.join(gaps, ["step_", "gap_"]))
    at = (capacity - F.col("room_") + F.col("place_") * F.col("size_")).cast("int")
    placed = met.select(F.lit(PLACED).alias("kind_"), "size_", "id_", "seq_", at.alias("at_"))
    taken = met.groupBy("seq_").agg(F.sum("size_").alias("taken_"))
    of_gap = taken.select(F.lit(GAP).alias("kind_"), F.col("seq_").alias("id_"), "taken_")
    of_piece = met.select(F.lit(PIECE).alias("kind_"), "id_", F.col("size_").cast("long").alias("taken_"))
    rest = state.join(of_gap.unionByName(of_piece), ["kind_", "id_"], "left")
    size = F.col("size_") - F.coalesce("taken_", F.lit(0))  # nothing is left of a piece that found a place
    none = F.lit(None)
    rest = rest.select("kind_", size.cast("int").alias("size_"), "id_", none.cast("long").alias("seq_"), none.cast("int").alias("at_"))
    return rest.where("size_ > 0").unionByName(placed)


def best_fit(sizes: DataFrame, capacity: int) -> DataFrame:
    """id_, seq_, at_: the sequence and place of each piece of ``sizes`` (id_, distinct, and size_ up to ``capacity``)."""
    size, none = F.col("size_").cast("int"), F.lit(None)
    empty = {"seq_": none.cast("long"), "at_": none.cast("int")}
    rows = sizes.select(F.lit(PIECE).alias("kind_"), size.alias("size_"), "id_").withColumns(empty)
    # How many pieces have each size: as many rows as sizes.
    counts = {r["size_"]: r["n"] for r in rows.groupBy("size_").agg(F.count("*").alias("n")).collect()}
    total, left = sum(s * n for s, n in counts.items()), sum(counts.values())
    # The largest pieces each start a sequence, as many as the tokens need at least.
    wanted = max(sum(n for s, n in counts.items() if 2 * s > capacity), -(-total // capacity))
    least, share = 0, 0.0
    for s in sorted(counts, reverse=True):
        least, share = s, min(1.0, wanted / counts[s])
        wanted -= counts[s]
        if wanted <= 0:
            break
    drawn = F.pmod(F.xxhash64(F.lit("first"), "id_"), F.lit(1 << 20)) < int(share * (1 << 20))
    first = (F.col("size_") > least) | ((F.col("size_") == least) & drawn)
    placed = rows.where(first).withColumns({"kind_": F.lit(PLACED), "seq_": F.col("id_"), "at_": F.lit(0)})
    gaps = rows.where(first & (F.col("size_") < capacity)).withColumns({"kind_": F.lit(GAP), "size_": capacity - size})
    state = keep(rows.where(~first).unionByName(placed).unionByName(gaps))
    done = [state.where(F.col("kind_") == PLACED)]
    while True:
        pieces_, gap = F.when(F.col("kind_") == PIECE, F.col("size_")), F.when(F.col("kind_") == GAP, F.col("size_"))
        left_before = left
        n, low, high, room, left = state.agg(
            F.count("*"), F.min(pieces_), F.max(pieces_), F.max(gap), F.count(pieces_)
        ).first()
        if not left:
            break
        parts = min(MOST_CELLS, 1 + n // CELL_ROWS)
        fullest = room or 0
        # When a round places hardly any of what is left, gaps are too few to take one piece each.
        few = done[1:] and (left_before - left) * 100 < left
        todo = state.where((F.col("kind_") == PIECE) | (F.col("kind_") == GAP) & (F.col("size_") >= low))
        too_large = (F.col("kind_") == PIECE) & (F.col("size_") > fullest)
        if high > fullest:
            new = opened(todo.where(too_large).select("size_", "id_"), capacity, parts)
            state = keep(todo.where(~too_large).unionByName(new))
        elif few:
            state = keep(fill(todo.select("kind_", "size_", "id_"), capacity, parts))
        else:
            state = keep(sweep(todo.select("kind_", "size_", "id_"), capacity, parts))
        done.append(state.where(F.col("kind_") == PLACED))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("id_", "seq_", "at_")


def packed(docs: DataFrame, tokenizer: str, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for).

    A document is its ids and a closing 0; only longer ones are cut. A null or empty text is the 0 alone. Null doc_ids
    are kept. Repeated rows are documents of their own. An empty table gives no rows. Other columns are ignored.
    """
    made = keep(pieces(docs, tokenizer, capacity, with_ids).withColumn("id_", F.monotonically_increasing_id()))
    places = best_fit(made.select("id_", F.col("length").alias("size_")), capacity)
    return made.join(places, "id_").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.col("seq_").alias("sequence_id"),
        F.col("at_").cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
