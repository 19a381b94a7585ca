"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

Candidates are words that hold a long run of letters, digits and signs with a digit in it, or a value given to a name
that speaks of secrets. What is known of each: its length, how its characters follow one another, how much of it the
dictionary of the corpus covers, the path it was found under, and the words around it. Only built-in functions and
Spark's own forest are used.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import SPACE, keep, some_of_each

# Names that secrets are assigned to, and words of paths where secrets are examples.
SPEAKING = "token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key"
EXAMPLES = "test|example|sample|mock|fixture|dummy|doc"
#: A long run, and what a value given to a speaking name looks like.
RUN = r"[A-Za-z0-9+/_.\-]{16,}={0,2}"
ASSIGNED = rf"(?i)(?:{SPEAKING})[\"']?\s*[:=]\s*[\"']?[^\s\"']{{6,}}"
#: That value itself: up to a closing quote; or else up to "&", signs that close, or the next name and its sign.
VALUE = (
    r"((?<=[\"'])[^\s\"']{6,}(?=[\"'])|[^\s\"'&]{6,}?(?=[,;)}\]>]*(?:[\s\"'&]|$)|[,;?][\"']?[\w.\-]+[\"']?[:=]))"
)
WITHIN = rf"(?i)(?:{SPEAKING})[\"']?[:=][\"']?{VALUE}"
#: The same with its name in the words before.
ACROSS = rf"(?i)(?:{SPEAKING})[\"']?(?:\s+[:=]\s*|[:=]\s+)[\"']?{VALUE}\S*$"
#: Labelled findings of each label that the forest learns from, at most, and its size.
FIT_ROWS, TREES, DEPTH = 10_000, 24, 8
#: Share of documents that a word of four to eight letters must be in to count as dictionary, and documents at least.
COMMON, COMMON_ROWS = 0.0005, 5
#: Cells that neighbouring words, and paths, are hashed into.
CELLS = 64


def _bound(value, body):
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def findings(docs: DataFrame, path_col: str = "source") -> DataFrame:
    """doc_id, path, word_no (from 0), candidate, before (up to three words), after (one): every candidate.

    A word may hold several candidates; each is a row.
    """
    words = F.split(F.coalesce("text", F.lit("")), f"[{SPACE}]+")
    run, digit = F.lit(f"{RUN}"), r"[0-9]"
    at = lambda w, i: F.coalesce(F.get(w, i), F.lit(""))

    def is_candidate(w, i):
        before = F.concat_ws(" ", at(w, i - 2), at(w, i - 1), at(w, i))
        return (w[i].rlike(RUN) & w[i].rlike(digit)) | (F.length(w[i]) >= 6) & before.rlike(ASSIGNED)

    def found(w):
        spots = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: is_candidate(w, i))
        return F.transform(
            spots,
            lambda i: F.struct(
                i.alias("word_no"),
                w[i].alias("word"),
                F.array(at(w, i - 3), at(w, i - 2), at(w, i - 1)).alias("before"),
                at(w, i + 1).alias("after"),
            ),
        )

    rows = docs.select("doc_id", F.col(path_col).cast("string").alias("path"), F.explode(_bound(words, found)).alias("f_"))
    rows = rows.select("doc_id", "path", "f_.*")
    runs = F.filter(F.regexp_extract_all("word", run, F.lit(0)), lambda c: c.rlike(digit))
    # Values of speaking names, however short, beside the runs.
    nearest = F.concat_ws(" ", F.get("before", F.lit(1)), F.get("before", F.lit(2)), "word")
    values = F.concat(F.regexp_extract_all("word", F.lit(WITHIN), F.lit(1)), F.array(F.regexp_extract(nearest, ACROSS, 1)))
    every = F.array_distinct(F.concat(runs, F.filter(values, lambda c: c != "")))
    # A word near a name, but no clear value of it: what is inside of quotes and signs.
    value = F.regexp_extract("word", r"([^\s\"'=:]{6,})[\"',;]*$", 1)
    every = F.when(F.size(every) > 0, every).otherwise(F.array(value))
    return rows.withColumn("candidate", F.explode(every)).where("candidate <> ''")


def labelled_by_rule(rows: DataFrame):
    """A label for findings when there is none by hand: the candidate is a quoted or plain value of a speaking name."""
    around = F.concat_ws(" ", F.get("before", F.lit(1)), F.get("before", F.lit(2)), F.col("word"))
    example = F.coalesce(F.col("path"), F.lit("")).rlike(f"(?i){EXAMPLES}")
    return (around.rlike(ASSIGNED) & ~example).cast("int")


def dictionary(docs: DataFrame) -> DataFrame:
    """part: words of four to eight letters that a share of all documents hold."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\b[a-z]{4,8}\b"), F.lit(0)))
    counted = docs.select(F.explode(words).alias("part")).groupBy("part").agg(F.count("*").alias("n"))
    least = docs.agg(F.greatest(F.ceil(F.count("*") * F.lit(COMMON)), F.lit(COMMON_ROWS)).alias("least"))
    # One row, the number of documents.
    return counted.join(F.broadcast(least), F.col("n") >= F.col("least")).select("part")


def coverage(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """candidate, coverage: the share of its characters that lie in dictionary words."""
    size = F.length("candidate")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(size - 3, F.lit(1)))).alias("start")
    pieces = candidates.select("candidate", starts).select("candidate", "start", F.explode(F.array(*map(F.lit, range(4, 9)))).alias("n"))
    pieces = pieces.where(F.col("start") + F.col("n") - 1 <= size).withColumn("part", F.lower(F.substring("candidate", F.col("start"), F.col("n"))))
    spots = F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("spot")
    # Spark takes pieces to be as few as candidates, so a join that could broadcast them would; a semi join can't.
    known = pieces.join(words, "part", "left_semi")
    inside = known.select("candidate", spots).distinct().groupBy("candidate").agg(F.count("*").alias("inside"))
    share = F.coalesce(F.col("inside"), F.lit(0)) / F.length("candidate")
    return candidates.join(inside.hint("merge"), "candidate", "left").select("candidate", share.alias("coverage"))


def _pairs(text):
    """The pairs of characters of a column, told apart as a letter of a-z, a digit or a sign; capitals are signs of case."""
    flat = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[A-Z]", "A"), "[0-9]", "0"), "[^a-zA0]", "#")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1))), lambda i: F.substring(flat, i, 2))


def transitions(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """candidate, follow: how usual its pairs of characters are in the words around all findings (mean log share)."""
    near = rows.select(F.explode(F.concat("before", F.array("after"))).alias("word")).where(F.length("word") >= 2)
    seen = near.select(F.explode(_pairs(F.col("word"))).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    # A pair is two of 29 characters, so this is a small table.
    share = F.log((F.col("n") + 1) / (F.sum("n").over(Window.partitionBy(F.lit(0))) + 841))
    usual = seen.select("pair", share.alias("usual"))
    own = candidates.select("candidate", F.explode(_pairs(F.col("candidate"))).alias("pair"))
    rare = F.lit(-16.0)
    joined = own.join(usual, "pair", "left")
    return joined.groupBy("candidate").agg(F.avg(F.coalesce("usual", rare)).alias("follow"))


def features(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` with ``features_``. What depends on the candidate alone is computed once for each distinct one."""
    candidates = rows.select("candidate").distinct()
    known = coverage(candidates, dictionary(docs)).join(transitions(rows, candidates), "candidate")
    c, size = F.col("candidate"), F.length("candidate")
    share = lambda kind: F.coalesce(F.regexp_count(c, F.lit(kind)), F.lit(0)) / size
    numbers = {
        "length_": F.least(size, F.lit(1000)).cast("double"),
        "digits_": share("[0-9]"),
        "capitals_": share("[A-Z]"),
        "signs_": share("[^A-Za-z0-9]"),
        "hex_": F.when(c.rlike("^[0-9a-fA-F]+$"), 1.0).otherwise(0.0),
        # Changes between letters and digits, and between small and capital letters.
        "changes_": share("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "different_": F.size(F.array_distinct(F.split(c, ""))) / size,
        "quoted_": F.when(F.col("word").rlike("[\"']"), 1.0).otherwise(0.0),
        "example_": F.when(F.coalesce(F.col("path"), F.lit("")).rlike(f"(?i){EXAMPLES}"), 1.0).otherwise(0.0),
    }
    place = F.array(F.concat(F.lit("path:"), F.regexp_replace(F.coalesce("path", F.lit("")), "[0-9]+", "")))
    named = lambda w, side: F.concat(F.lit(side), F.lower(w))
    around = F.concat(
        place, F.transform("before", lambda w: named(w, "before:")), F.array(named(F.col("after"), "after:"))
    )
    # Every candidate is known; a left join never broadcasts the rows, which may hold one long word again and again.
    made = rows.join(known, "candidate", "left").withColumns(numbers | {"around_": around})
    hashed = HashingTF(numFeatures=CELLS, binary=True, inputCol="around_", outputCol="cells_").transform(made)
    columns = [*numbers, "coverage", "follow", "cells_"]
    ready = VectorAssembler(inputCols=columns, outputCol="features_").transform(hashed)
    return ready.drop(*numbers, "around_", "cells_")


def scan(docs: DataFrame, labels: DataFrame | None = None, path_col: str = "source", most: int = FIT_ROWS) -> DataFrame:
    """One row per candidate: doc_id, word_no, candidate, score (0 to 1), predicted (1: a secret).

    ``labels`` has doc_id, word_no, candidate and label (0 or 1) of findings judged by hand; without it, findings are
    labelled by ``labelled_by_rule``. The forest learns from up to ``most`` findings a label, chosen by hash, of
    documents that are not held out (crc32 of the id not divisible by 5). With one label only, that label is the score.
    Null and empty texts have no candidates. Null ids are kept, but not learnt from. Repeated rows give repeated
    findings. An empty table gives no rows. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text", F.col(path_col).alias("path_"))
    rows = keep(findings(docs, "path_"))
    ready = keep(features(rows, docs))
    if labels is None:
        judged = ready.withColumn("label", labelled_by_rule(ready))
    else:
        judged = ready.join(labels.select("doc_id", "word_no", "candidate", "label"), ["doc_id", "word_no", "candidate"])
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.lit(False))
    sample = some_of_each(judged.where(learn & F.col("label").isin(0, 1)), "label", ["doc_id", "word_no", "candidate"], most)
    sample = keep(sample.select("features_", F.col("label").cast("double").alias("label")))
    known = {r["label"] for r in sample.select("label").distinct().collect()}
    out = ["doc_id", "word_no", "candidate"]
    if len(known) < 2:
        only = float(known.pop()) if known else 0.0
        return ready.select(*out, F.lit(only).alias("score"), F.lit(int(only)).alias("predicted"))
    forest = RandomForestClassifier(featuresCol="features_", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=1)
    judged = forest.fit(sample).transform(ready)
    score = F.get(vector_to_array("probability"), F.lit(1))
    return judged.select(*out, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
