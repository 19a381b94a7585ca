"""Language identification by string kernels.

Two texts are as alike as the runs of one to three characters that both have, whatever their number: a blended-spectrum
presence kernel, normalised by how many different runs each has. Kernel ridge regression, one language against the
rest, is fitted on a bounded sample, with some of its texts as Nyström landmarks. The kernel with a landmark is a
product with the landmark's presences, so the landmarks and weights fold into one matrix of runs by languages, and a
batch of texts is scored by one product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import keep

#: Texts that the model is fitted on, at most, and how many of them are landmarks; both are shared out by language.
FIT_ROWS, LANDMARKS = 1600, 320
#: Ridge, and symbols that characters are told apart by: 0 for other than letters, then a-z, then by code point.
RIDGE, SYMBOLS = 0.05, 64
#: Where runs of one, two and three symbols begin in the space of all runs.
STARTS = (0, SYMBOLS, SYMBOLS + SYMBOLS**2)
RUNS = SYMBOLS + SYMBOLS**2 + SYMBOLS**3
BATCH = 256


def _symbols() -> np.ndarray:
    """The symbol of each code point of the first plane; letters beyond a-z share the rest of the symbols."""
    table = np.zeros(1 << 16, dtype=np.int32)
    for point in range(len(table)):
        if chr(point).isalpha():
            table[point] = point - 96 if 97 <= point <= 122 else 27 + point % (SYMBOLS - 27)
    return table


_TABLE: list[np.ndarray] = []


def symbols(text: str | None) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_symbols())
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found = _TABLE[0][points & 0xFFFF]
    for point in np.unique(points[points >= 1 << 16]).tolist() if (points >= 1 << 16).any() else ():
        found[points == point] = 27 + (point & 0xFF) % (SYMBOLS - 27) if chr(point).isalpha() else 0
    return found


def runs(text: str | None) -> tuple[np.ndarray, bool]:
    """The different runs of a text, in order, and whether it has a letter. A space stands at both ends."""
    inner = symbols(text)
    s = np.concatenate(([0], inner, [0]))
    pairs = s[:-1] * SYMBOLS + s[1:]
    codes = [s, STARTS[1] + pairs, STARTS[2] + pairs[:-1] * SYMBOLS + s[2:]]
    if len(s) < 4000:
        return np.unique(np.concatenate(codes)), bool(inner.any())
    present = np.zeros(RUNS, dtype=bool)
    for c in codes:
        present[c] = True
    return np.flatnonzero(present), bool(inner.any())


@dataclass(frozen=True)
class Model:
    """``column`` of each run (-1: no landmark has it) and ``weights`` by column and language."""

    languages: list[str]
    column: np.ndarray
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; ``und`` and 0 without a letter, or without any language learnt."""
        names, scores = [], []
        for start in range(0, len(texts), BATCH):
            found = [runs(t) for t in texts[start : start + BATCH]]
            x = np.zeros((len(found), len(self.weights)), dtype=np.float32)
            for row, (codes, _) in zip(x, found):
                at = self.column[codes]
                row[at[at >= 0]] = 1
            margins = x @ self.weights / np.sqrt([[max(len(codes), 1)] for codes, _ in found])
            for margin, (_, letters) in zip(margins, found):
                known = letters and len(self.languages) > 0
                best = int(np.argmax(margin)) if known else 0
                names.append(self.languages[best] if known else "und")
                scores.append(float(np.clip((margin[best] + 1) / 2, 0, 1)) if known else 0.0)
        return names, scores


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from learning; a row without an id is not learnt from either."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """lang and bits_ (presences, packed) of up to ``most`` rows, as many for each language, chosen by hash; with more
    languages than ``most``, of as many languages."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("doc_id", "lang")
    each = max(1, most // max(1, known.select("lang").distinct().count()))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "lang"), "doc_id")
    chosen = known.withColumn("rank_", F.row_number().over(order)).where(F.col("rank_") <= each)
    # Ids and languages of the bounded sample only.
    few = chosen.orderBy("rank_", F.xxhash64("lang"), "lang").limit(most)
    ids = F.broadcast(few.select("doc_id", "lang").dropDuplicates(["doc_id"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for text in batch.column(2):
                flags = np.zeros(RUNS, dtype=bool)
                flags[runs(text.as_py())[0]] = True
                bits.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(bits, pa.binary())], ["doc_id", "lang", "bits_"])

    texts = docs.select("doc_id", "text").join(ids, "doc_id").select("doc_id", "lang", "text")
    return texts.mapInArrow(run, "doc_id long, lang string, bits_ binary")


def fit(docs: DataFrame, most: int = FIT_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Learn from a bounded sample; its presences (33 KB a text) come to the driver."""
    sample = keep(labelled_sample(docs, most)).toPandas().sort_values(["doc_id", "lang"], kind="stable")
    languages = sorted(sample["lang"].unique())
    if not languages:
        return Model([], np.full(RUNS, -1, dtype=np.int32), np.zeros((1, 0), dtype=np.float32))
    bits = np.stack([np.frombuffer(b, dtype=np.uint8) for b in sample["bits_"]])
    place = sample.groupby("lang").cumcount().to_numpy()
    marks = place < max(4, landmarks // len(languages))
    # Runs that no landmark has add nothing to any kernel value.
    shared = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bits[marks]))[:RUNS])
    sizes = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    # A few texts at a time: unpacked, all runs of all texts would take eight times as much.
    x = np.concatenate([np.unpackbits(b, axis=1)[:, shared].astype(np.float32) for b in np.array_split(bits, 32)])
    x /= np.sqrt(sizes)[:, None].astype(np.float32)
    z = x[marks]
    values, vectors = np.linalg.eigh((z @ z.T).astype(float))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = (x @ z.T).astype(float) @ root
    target = np.where(sample["lang"].to_numpy()[:, None] == np.array(languages)[None], 1.0, -1.0)
    # Each language counts the same, however many texts of it there are.
    per = sample.groupby("lang")["lang"].transform("size").to_numpy()
    weight = (len(sample) / len(languages) / per)[:, None]
    solved = np.linalg.solve(phi.T @ (weight * phi) + ridge * np.eye(phi.shape[1]), phi.T @ (weight * target))
    column = np.full(RUNS, -1, dtype=np.int32)
    column[shared] = np.arange(len(shared))
    return Model(languages, column, (z.T @ (root @ solved)).astype(np.float32))


def identify(docs: DataFrame, most: int = FIT_ROWS, landmarks: int = LANDMARKS) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1), learnt from its rows with a language that are not held out.

    The whole text counts. A null text, or one without a letter, is ``und`` with score 0; so is every text if no row
    has a language. Repeated rows each give a row; an empty table gives none. Columns of these names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, most, landmarks))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = sent.value.predict(list(texts))
        return pd.DataFrame({"lang_pred": names, "score": scores})

    made = docs.withColumn("made_", predict("text"))
    return made.withColumns({"lang_pred": F.col("made_.lang_pred"), "score": F.col("made_.score")}).drop("made_")
