"""The queries over the operators of this package, and their expected results in SQL where SQL can express them."""

from __future__ import annotations

import re
import tempfile
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, exact, html, language, lines, minhash, mixing, packing, repeats, secrets, simhash, spelling, toxicity
from .store import SPACE


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the data folder. Only a session on one machine, as in tests, is given a folder of its own here."""
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    if unset and re.match(r"local($|\[)", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fieldtrail-"))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """The definition of a public tokenizer, read where the driver is."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_pack(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.packed(table(spark, folder, "documents"), tokenizer())


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents: words in threes, three differing bits."""
    return simhash.near_groups(table(spark, folder, "documents"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which document stays for each document, equal texts being one."""
    return exact.exact_groups(table(spark, folder, "documents"))


def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    """Title and visible text of all pages."""
    return html.extract(table(spark, folder, "pages"))


def op5_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of 150% of all words takes of each document, sources weighing 3, 1, 2 in turn."""
    return mixing.mix_plan(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of all documents, learnt from those that are not held out."""
    made = language.identify(table(spark, folder, "documents"))
    return made.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learnt from four fifths of the labelled ones."""
    scored = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without lines of 20 characters or more that three or more documents hold."""
    made = lines.dedup_lines(table(spark, folder, "documents"))
    return made.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op9_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest embeddings of each whose id is divisible by 100."""
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates for secrets in all documents, judged by a forest that learnt from rule-labelled findings."""
    return secrets.scan(table(spark, folder, "documents"))


def op11_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents: sets of words in threes that are 85% alike."""
    return minhash.near_groups(table(spark, folder, "documents"))


def misspelt(doc_id: int | None, word: str) -> str:
    """The word without one letter in about one of 31 documents; a null id is written as nothing."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    return word if h % 31 else word[: h % len(word)] + word[h % len(word) + 1 :]


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of seven letters or more that are one letter apart, with letters left out here and there."""
    return spelling.spelling_variants(table(spark, folder, "documents"), misspelt)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts (crc32 of the id divisible by 10) end in a repetition of own words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"[^{SPACE}]+"), F.lit(0)))
    tenth = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"), F.size(words).alias("n"))
    placed = tenth.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = F.expr("flatten(array_repeat(slice(words, int(a + 1), int(p)), int((n - a + p - 1) div p)))")
    made = F.array_join(F.slice(F.concat(F.expr("slice(words, 1, int(a))"), tail), 1, F.col("n")), " ")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which are given a repetition at their end."""
    return repeats.periodic_runs(with_periodic_tails(table(spark, folder, "documents")), whole=False)


QUERIES = {
    "op1_pack": op1_pack,
    "op2_simhash": op2_simhash,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_html": op4_html,
    "op5_mix": op5_mix,
    "op6_language": op6_language,
    "op7_toxicity": op7_toxicity,
    "op8_line_dedup": op8_line_dedup,
    "op9_nearest": op9_nearest,
    "op10_secrets": op10_secrets,
    "op11_minhash": op11_minhash,
    "op12_spelling": op12_spelling,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op3_exact_dedup": r"""
        with bare as (
            select doc_id, length(coalesce(text, '')) n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') b
            from documents
        ), placed as (
            select doc_id, b, count(*) over (partition by b) group_size,
                   first_value(doc_id) over (partition by b order by n desc, doc_id nulls last) keep_id
            from bare
        )
        select doc_id, keep_id, group_size, doc_id = keep_id kept, sha256(b) text_sha256 from placed
    """,
    "op8_line_dedup": r"""
        with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) parts from documents),
        lines as (
            select doc_id, i, parts[i] line,
                   translate(trim(parts[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key
            from (select doc_id, parts, unnest(range(1, len(parts) + 1)) i from docs)
        ), common as (
            select key, max(doc_id) keeper from lines where length(key) >= 20
            group by key having count(distinct doc_id) >= 3
        ), judged as (
            select l.doc_id, i, line, c.keeper is not null and c.keeper <> l.doc_id dropped
            from lines l left join common c using (key)
        )
        select doc_id, count(*) n_lines, count(*) filter (dropped) n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by i) filter (not dropped), '')) kept_sha256
        from judged group by doc_id
    """,
}
