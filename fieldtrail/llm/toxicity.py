"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens of labelled documents are counted once per document; their log-odds between toxic and other documents, with a
Dirichlet prior from all of them, give each significant token a score, and every other token a small negative one. One
linear scan of a whole text finds all maximal segments (each is a passage that no neighbour improves). How high a
segment scores by chance in a text of that length follows an extreme-value law; the document's score adds up what its
significant segments exceed it by.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .simhash import shingle_hashes
from .store import keep, portions, release, some_of_each

#: Labelled documents of each label that the model is learnt from, at most; chosen by hash. This bounds fitting only.
FIT_ROWS = 15_000
#: Score of a token that says nothing: passages do not reach over more than some tens of such tokens.
DRIFT = -0.25
#: Standard errors that a token's log-odds must exceed zero by, and the least score (log-odds less one error) of use.
SIGNIFICANT, LEAST = 3.0, 1.0
#: Lengths of the beginnings of words that are tokens too.
STEMS = (4, 5, 6)
#: Segments whose expected number by chance is above this do not count.
EXPECTED = 0.05

_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def forms(token: str) -> list[str]:
    """A token and its beginnings, so that an inflected word is known by its stem."""
    return [token, *(token[:n] + "*" for n in STEMS if len(token) > n)]


def hits(words: list[str], table: dict[str, float]) -> list[tuple[int, float]]:
    """Positions and scores of the tokens that the table knows, by their best form."""
    found, get = [], table.get
    for i, word in enumerate(words):
        score = get(word, 0.0)
        for n in STEMS:
            if len(word) > n and (other := get(word[:n] + "*", 0.0)) > score:
                score = other
        if score:
            found.append((i, score))
    return found


def segments(scores: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[float, int, int]]:
    """All maximal segments (score, first, last) of a sequence of ``drift`` with the given positive positions.

    ``scores`` has (position, score) in order. One pass with a stack of candidates, each with the running sum before and
    after it. A new piece is joined with the last candidate that starts lower, if that ends lower too. Once the sum is
    below all starts, nothing before it can be joined any more.
    """
    done: list[tuple[float, float, int, int]] = []
    stack: list[tuple[float, float, int, int]] = []  # sum before, sum after, first, last
    total, at = 0.0, 0
    for position, score in scores:
        total += drift * (position - at)
        left, right, first = total, total + score, position
        total, at = right, position + 1
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][0] >= left:
                k -= 1
            if k >= 0 and stack[k][1] < right:
                left, first = stack[k][0], stack[k][2]
                del stack[k:]
                continue
            if k < 0:
                done += stack
                stack = []
            stack.append((left, right, first, position))
            break
    return [(after - before, first, last) for before, after, first, last in done + stack]


@dataclass(frozen=True)
class Model:
    """Scores of the significant tokens, and the extreme-value law of a segment's score by chance."""

    scores: dict[str, float]
    drift: float
    rate: float  # lambda
    log_k: float
    slope: float
    offset: float

    def evidence(self, text: str | None) -> float:
        """How far the significant segments of a text exceed chance, in units of the extreme-value law."""
        words = tokens(text)
        found = hits(words, self.scores)
        if not found:
            return 0.0
        level = self.log_k + math.log(len(words))
        above = (self.rate * s - level for s, _, _ in segments(found, self.drift))
        return sum(x for x in above if x > -math.log(EXPECTED))

    def score(self, text: str | None) -> float:
        return 1.0 / (1.0 + math.exp(-(self.offset + self.slope * math.log1p(self.evidence(text)))))


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from learning; a row without an id is not learnt from either."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """text and toxic of up to ``most`` labelled documents a label, without held-out ones.

    A document with contradicting labels, or a null label, is not used. Only the chosen ids are joined with the texts.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most_"))
        .where("toxic = most_")
    )
    chosen = some_of_each(known, "toxic", ["doc_id"], most)
    # At most 2 * most rows of an id and a label.
    return docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id")


@F.arrow_udf(T.LongType())
def _copy_mark(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A number that near copies of a text mostly share: the least hash of its runs of three words."""
    for texts in batches:
        yield pa.array([min(shingle_hashes(t.as_py(), 3), default=0) >> 1 for t in texts], pa.int64())
    release()


def _all_forms(text: str | None) -> list[str]:
    return sorted({f for word in set(tokens(text)) for f in forms(word)})


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each form of each text. Forms take many times the room of their texts, so they leave in portions."""
    for batch in batches:
        labels = batch.column(1).to_numpy()
        for texts in portions(batch.column(0), 250_000):
            found = [_all_forms(t) for t in texts]
            sizes = np.array([len(f) for f in found], dtype=np.int64)
            own, labels = labels[: len(texts)], labels[len(texts) :]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for f in found for w in f], pa.string()), pa.array(np.repeat(own, sizes), pa.int32())],
                ["token_", "toxic"],
            )
    release()


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Model:
    """Learn from the labelled rows; without rows of both labels, no text is toxic."""
    sample = keep(labelled_sample(docs, labels, most))
    # Near copies of one document would make its chance words look like evidence: one of them is counted.
    once = sample.withColumn("copy_", _copy_mark("text")).dropDuplicates(["copy_", "toxic"])
    once = keep(once.select("text", F.col("toxic").cast("int")))
    counts = {r["toxic"]: r["n"] for r in once.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    if not n1 or not n0:
        return Model({}, DRIFT, 1.0, 0.0, 1.0, -5.0)
    by_token = (
        once.mapInArrow(_token_rows, "token_ string, toxic int")
        .groupBy("token_")
        .agg(F.sum("toxic").alias("in1"), F.count("*").alias("in_all"))
        .withColumn("in0", F.col("in_all") - F.col("in1"))
    )
    # The prior of a token: what one document in a hundred would have of it, split as documents are.
    prior = lambda n: F.lit(0.01 * n / (n1 + n0)) * F.col("in_all") + F.lit(0.05 * n / (n1 + n0))
    a1, a0 = F.col("in1") + prior(n1), F.col("in0") + prior(n0)
    odds = F.log(a1 / (n1 * 1.01 - a1 + 1)) - F.log(a0 / (n0 * 1.01 - a0 + 1))
    error = F.sqrt(1 / a1 + 1 / a0)
    significant = (
        by_token.where("in1 >= 4")
        .select("token_", odds.alias("odds"), error.alias("error"), "in0")
        .where(F.col("odds") > SIGNIFICANT * F.col("error"))
        .select("token_", (F.col("odds") - F.col("error")).alias("score"), "in0")
        .where(F.col("score") >= LEAST)
    )
    # A token needs several toxic documents, so these are far fewer than the tokens of the bounded sample.
    table = significant.toPandas().sort_values("token_")
    scores = dict(zip(table["token_"], table["score"].clip(upper=8.0)))
    if not scores:
        return Model({}, DRIFT, 1.0, 0.0, 1.0, -5.0)
    lengths = once.where("toxic = 0").agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 1
    chance = (table["in0"].to_numpy(float) + 0.5) / (lengths + 1)
    rate = _karlin(np.array(list(scores.values())), chance, DRIFT)
    # K from the rate of the lowest score that any token starts a segment with.
    least = min(scores.values())
    log_k = min(0.0, math.log(chance.sum()) + rate * least)
    draft = Model(scores, DRIFT, rate, log_k, 1.0, 0.0)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [math.log1p(draft.evidence(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1)], ["x", "toxic"])
        release()

    seen = sample.select("text", F.col("toxic").cast("int")).mapInArrow(evidence, "x double, toxic int")
    points = seen.groupBy(F.round("x", 2).alias("x"), "toxic").agg(F.count("*").alias("n")).toPandas()
    slope, offset = _logistic(points)
    return Model(scores, DRIFT, rate, log_k, slope, offset)


def _karlin(scores: np.ndarray, chance: np.ndarray, drift: float) -> float:
    """The positive root of the sum of p * exp(rate * score) = 1, all other tokens having the drift."""
    rest = 1 - chance.sum()
    low, high = 1e-6, 50.0
    for _ in range(200):
        middle = (low + high) / 2
        total = float((chance * np.exp(np.minimum(middle * scores, 600))).sum() + rest * math.exp(middle * drift))
        low, high = (middle, high) if total < 1 else (low, middle)
    return low


def _logistic(points: pd.DataFrame, ridge: float = 1e-3) -> tuple[float, float]:
    """Weighted logistic regression of toxic on x, by Newton steps; the slope is not negative."""
    x = np.column_stack([points["x"], np.ones(len(points))])
    y, n, w = points["toxic"].to_numpy(float), points["n"].to_numpy(float), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (y - p)) - ridge * w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 0.0), float(w[1])


def scorer(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS):
    """A function of a text column that gives its score, learnt from ``docs`` and ``labels``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([model.value.score(t.as_py()) for t in texts], pa.float64())
        release()

    return score


def toxicity(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 if score is 0.5 or more), from whole texts.

    A null or empty text has no passage and gets the score of such texts. Tables without usable labels give low scores.
    Repeated rows each give a row; an empty table gives none. Columns named score or predicted are replaced.
    """
    scored = docs.withColumn("score", scorer(docs, labels, most)("text"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """``docs``, unchanged, without those that score 0.5 or more. A null text stays."""
    return docs.where(scorer(docs, labels, most)("text") < 0.5)


def find_passages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, first, last (token numbers), score, expected (by chance) of every significant passage."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found, m = [], sent.value
            for id_, text in zip(rows["doc_id"], rows["text"]):
                words = tokens(text)
                for s, first, last in segments(hits(words, m.scores), m.drift):
                    expected = math.exp(m.log_k + math.log(len(words)) - m.rate * s)
                    if expected <= EXPECTED:
                        found.append((id_, first, last, s, expected))
            yield pd.DataFrame(found, columns=["doc_id", "first", "last", "score", "expected"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        run, "doc_id long, first long, last long, score double, expected double"
    )
