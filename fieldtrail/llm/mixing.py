"""Mixing sources to target weights, by budget cuts in a random order of each source.

Every row gets a hash-random key. The key space is cut into ranges; the words of a range are summed where the rows
are, and a running sum over the ranges of a source finds the range in which its budget ends. Only that range is sorted
row by row. What remains per source is one number of whole epochs and one key to cut at, so no text is shuffled, and a
source with a third of all rows is never in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import SPACE, keep, words

#: Bits of the key that name its range: 4,096 ranges a source.
RANGE_BITS = 12


def sized(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with ``size_`` (words), ``key_`` (hash-random) and the source as a null flag and a text without nulls."""
    text = F.col(text_col)
    return docs.withColumns(
        {
            "size_": words(text),
            "key_": F.xxhash64(F.lit("mix"), F.col(id_col), text),
            "no_source_": F.col(source_col).isNull(),
            "source_": F.coalesce(F.col(source_col).cast("string"), F.lit("")),
        }
    )


SOURCE = ["no_source_", "source_"]


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """One row per source: ``source_size`` and ``target``.

    A source's share goes by its weight, but stops at ``most`` times its size; what is above goes to the others by
    weight, until none is above. With the sources in order of size per weight, one running sum finds the level at which
    the rest is shared. One row per source: the window without a partition is over sources, not documents.
    """
    by_source = sizes.groupBy(*SOURCE).agg(F.sum("size_").alias("source_size"))
    place = F.row_number().over(Window.orderBy(*SOURCE)) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (place % len(weights) + 1).cast("int"))
    every = Window.orderBy("per_weight", *SOURCE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("per_weight", *SOURCE).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        by_source.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("per_weight", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn(
            "level",
            (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
        )
    )
    level = F.first(F.when(F.col("level") < F.col("per_weight"), F.col("level")), ignorenulls=True).over(every)
    target = F.when(level.isNull(), F.col("limit")).otherwise(F.least("limit", F.col("weight") * level))
    return ranked.withColumn("target", target).select(*SOURCE, "source_size", "target")


def cuts(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: ``target``, ``epochs_`` (whole passes), and where the last pass ends.

    Rows whose key is below ``cut_`` are in the last pass. Rows at ``cut_`` (one, unless rows repeat) share its last
    ``rest_`` words in proportion to their sizes, which add up to ``at_cut_``.
    """
    span = F.shiftright("key_", 64 - RANGE_BITS)
    goal = targets(sizes, weights, share, most).withColumn(
        "epochs_", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    )
    goal = goal.withColumn("budget_", F.floor(F.col("target")).cast("long") - F.col("epochs_") * F.col("source_size"))
    ranges = sizes.groupBy(*SOURCE, span.alias("range_")).agg(F.sum("size_").alias("in_range"))
    until = Window.partitionBy(*SOURCE).orderBy("range_")
    last = (
        ranges.withColumn("until", F.sum("in_range").over(until))
        .join(goal, SOURCE)
        .where((F.col("budget_") > F.col("until") - F.col("in_range")) & (F.col("budget_") <= F.col("until")))
        .select(*SOURCE, "range_", (F.col("budget_") - F.col("until") + F.col("in_range")).alias("left"))
    )
    running = Window.partitionBy(*SOURCE).orderBy("key_")
    ends = (
        sizes.withColumn("range_", span)
        .join(last, [*SOURCE, "range_"])
        .groupBy(*SOURCE, "key_", "left")
        .agg(F.sum("size_").alias("at_cut_"))
        .withColumn("until", F.sum("at_cut_").over(running))
        .where((F.col("left") > F.col("until") - F.col("at_cut_")) & (F.col("left") <= F.col("until")))
        .select(
            *SOURCE,
            F.col("key_").alias("cut_"),
            "at_cut_",
            (F.col("left") - F.col("until") + F.col("at_cut_")).alias("rest_"),
        )
    )
    return goal.join(ends, SOURCE, "left")


def taken_last():
    """Words that the last, partial pass takes of a row joined with ``cuts``."""
    share = F.floor(F.col("rest_") * F.col("size_") / F.col("at_cut_")).cast("long")
    return F.when(F.col("key_") < F.col("cut_"), F.col("size_")).when(F.col("key_") == F.col("cut_"), share).otherwise(
        F.lit(0).cast("long")
    )


def mix_plan(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (of its source), taken (words the mix takes).

    Sources in code point order, a null source last, have the ``weights`` in turn and share ``share`` times all words;
    none gets over ``most`` times what it has. Null text has size 0; a null doc_id is an ordinary value. Rows that
    repeat entirely count each, and at the cut they share what is left. An empty table gives no rows; a source without
    words has target 0. The same rows give the same mix in any order and partitioning. Other columns are ignored.
    """
    sizes = keep(sized(docs.select("doc_id", "text", "source")).drop("text", "source"))
    joined = sizes.join(keep(cuts(sizes, weights, share, most)), SOURCE)
    return joined.select(
        "doc_id",
        F.col("size_").alias("size"),
        "source_size",
        "target",
        (F.col("epochs_") * F.col("size_") + taken_last()).alias("taken"),
    )


def mixed(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each pass over a document.

    The document at a source's cut is there with its first words only. Documents without words are in no budget; they
    stay once.
    """
    # The row itself is one column, so that its names cannot clash.
    rows = sized(docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("doc_")))
    plan = keep(cuts(keep(rows.select(*SOURCE, "size_", "key_")), weights, share, most))
    joined = rows.join(plan, SOURCE)
    tail = taken_last()
    passes = F.when(F.col("size_") == 0, F.lit(1)).otherwise(F.col("epochs_") + F.when(tail > 0, 1).otherwise(0))
    part = F.array_join(
        F.slice(F.regexp_extract_all("text", F.lit(f"[{SPACE}]*[^{SPACE}]+"), F.lit(0)), 1, tail.cast("int")), ""
    )
    cut = (F.col("pass_") > F.col("epochs_")) & (tail < F.col("size_"))
    out = joined.where(passes > 0).withColumn("pass_", F.explode(F.sequence(F.lit(1), passes.cast("int"))))
    out = out.withColumn("text", F.when(cut, part).otherwise(F.col("text"))).withColumn("cut_text_", cut)

    def column(name: str):
        own = F.col("doc_").getField(name)
        if name == "text":
            return F.col("text")
        return F.when(F.col("cut_text_"), F.length("text").cast("long")).otherwise(own) if name == "n_chars" else own

    return out.select(*(column(c).alias(c) for c in docs.columns))
