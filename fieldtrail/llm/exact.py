"""Exact duplicates by deterministic block naming.

A text without its white space is cut into blocks of a fixed size. Equal blocks get one integer name (the smallest
number of an occurrence), then adjacent names are paired and the pairs named in the same way, until each document has
one name. Names stand for whole texts, never for hashes, so there are no collisions. Naming is an aggregation that
combines before its shuffle and a join back; the join can split a block that a third of all documents hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import SPACE, discard, keep

#: Code points of a block.
BLOCK = 1024


def named_blocks(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each block of each document: row_, doc_id, length_, sha_, blocks_, pos_, id_ (its own number), name_.

    An empty text is one empty block.
    """
    text = F.coalesce("text", F.lit(""))
    bare = F.regexp_replace(text, f"[{SPACE}]+", "")
    cut = F.regexp_extract_all("bare_", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    rows = (
        docs.select("doc_id", F.length(text).alias("length_"), bare.alias("bare_"))
        .withColumns({"row_": F.monotonically_increasing_id(), "sha_": F.sha2("bare_", 256)})
        .withColumn("cut_", F.when(F.col("bare_") == "", F.array(F.lit(""))).otherwise(cut))
        .withColumn("blocks_", F.size("cut_"))
        .select("row_", "doc_id", "length_", "sha_", "blocks_", F.posexplode("cut_").alias("pos_", "block_"))
        .withColumn("id_", F.monotonically_increasing_id())
    )
    names = rows.groupBy("block_").agg(F.min("id_").alias("name_"))
    # Only the first block carries what belongs to the document.
    first = {c: F.when(F.col("pos_") == 0, F.col(c)) for c in ("doc_id", "length_", "sha_")}
    return rows.withColumns(first).join(names, "block_").drop("block_")


def name_pairs(rows: DataFrame) -> DataFrame:
    """One level up: row_, pos_, id_, name_ of adjacent pairs; a last block without partner pairs with -1."""
    odd = F.col("pos_") % 2 == 1
    pairs = rows.groupBy("row_", F.shiftright("pos_", 1).alias("pos_")).agg(
        F.min("id_").alias("id_"),
        F.max(F.when(~odd, F.col("name_"))).alias("left_"),
        F.coalesce(F.max(F.when(odd, F.col("name_"))), F.lit(-1).cast("long")).alias("right_"),
    )
    names = pairs.groupBy("left_", "right_").agg(F.min("id_").alias("name_"))
    return pairs.join(names, ["left_", "right_"]).select("row_", "pos_", "id_", "name_")


def identities(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: row_, doc_id, length_, sha_, blocks_, name_. Texts are equal if blocks_ and name_ are.

    The loop runs once for each doubling of the longest document, and its tables hold numbers only.
    """
    named = keep(named_blocks(docs, block))
    most = named.agg(F.max("blocks_")).first()[0] or 1
    rows, old = named.where("blocks_ > 1").select("row_", "pos_", "id_", "name_"), []
    for _ in range((most - 1).bit_length()):
        rows = keep(name_pairs(rows))
        discard(*old)
        old = [rows]
    firsts = named.where("pos_ = 0").select("row_", "doc_id", "length_", "sha_", "blocks_", "name_")
    long = firsts.where("blocks_ > 1").drop("name_").join(rows.select("row_", "name_"), "row_")
    return firsts.where("blocks_ = 1").unionByName(long)


def exact_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after deleting white space; null counts as empty. Of equal texts the one with the most
    code points in the original stays, then the smallest doc_id; a null doc_id comes after all others, and of rows that
    repeat entirely one stays. An empty table gives no rows. Other columns are ignored.
    """
    rows = identities(docs, block)
    best = F.min(F.struct(-F.col("length_"), F.col("doc_id").isNull(), "doc_id", "row_")).alias("best_")
    groups = rows.groupBy("blocks_", "name_").agg(F.count("*").alias("group_size"), best)
    return rows.join(groups, ["blocks_", "name_"]).select(
        "doc_id",
        F.col("best_.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_") == F.col("best_.row_")).alias("kept"),
        F.col("sha_").alias("text_sha256"),
    )
