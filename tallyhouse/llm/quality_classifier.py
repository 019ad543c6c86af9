"""Quality classifier: Bradley-Terry scores learned from pairs of documents.

A pair says that one document is better than another; the model gives each a
score, and the logistic loss falls on the difference of their features. A
document is rejected when its score lies below a quantile of the scores of the
documents learned from: the share of poor ones among them.

A feature is a number that follows from the whole text alone. Null and empty
texts have features of nought and are scored like any other. Repeated rows get
the same score each. Without a pair to learn from, every score is 0.5. Columns
beside id and text are carried along and never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import fresh, slices

FEATURES = 16
CUT = 0.3
# At most so many labelled documents are learned from, those with the least hash of their id.
MOST_LABELLED = 20_000
PAIRS_EACH = 16


def features(text: str | None) -> np.ndarray:
    """Shares of kinds of bytes and words, and logarithms of lengths."""
    out = np.zeros(FEATURES)
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    counts = np.bincount(raw, minlength=256)
    size = len(raw)
    words = text.split()
    n = max(len(words), 1)
    lines = text.split("\n")
    out[0] = counts[65:91].sum() / size
    out[1] = counts[48:58].sum() / size
    out[2] = counts[[35, 36, 37, 38, 42]].sum() / n
    out[3] = counts[33] / n
    out[4] = counts[124] / n
    out[5] = counts[[44, 46]].sum() / n
    out[6] = counts[128:].sum() / size
    out[7] = counts[[9, 10, 11, 12, 13, 32]].sum() / size
    out[8] = np.log1p(size) / 10
    out[9] = size / n / 10
    out[10] = len(set(words)) / n
    out[11] = sum(map(eq, words, islice(words, 1, None))) / n
    out[12] = len(set(lines)) / len(lines)
    out[13] = np.log1p(len(lines)) / 10
    out[14] = counts[[60, 62, 64, 91, 92, 93, 94, 95, 96, 123, 125, 126]].sum() / size
    out[15] = float(bool(words))
    return out


@dataclass(frozen=True)
class Model:
    """Score: logistic of `slope * (weights . scaled features - threshold)`, moved so that
    the threshold lies at `CUT`."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(rows), 0.5)
        raw = ((rows - self.mean) / self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(raw + np.log(CUT / (1 - CUT)), -60, 60)))


def fit(rows: np.ndarray, good: np.ndarray, penalty: float = 1e-3, steps: int = 30) -> Model:
    """Newton's method on the mean logistic loss of pairs (a good row, a poor row).

    Each row of the rarer class meets `PAIRS_EACH` of the other, drawn with a fixed seed.
    """
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0)
    mean, scale = rows.mean(0), rows.std(0)
    scale[scale < 1e-9] = 1
    scaled = (rows - mean) / scale
    draw = np.random.default_rng(7)
    n = PAIRS_EACH * min(len(better), len(worse))
    first = np.resize(better, n) if len(better) <= len(worse) else draw.choice(better, n)
    second = draw.choice(worse, n) if len(better) <= len(worse) else np.resize(worse, n)
    difference = scaled[first] - scaled[second]
    weights = np.zeros(FEATURES)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(difference @ weights, -60, 60)))
        gradient = difference.T @ (p - 1) / n + penalty * weights
        bend = (difference * (p * (1 - p))[:, None]).T @ difference / n
        step = np.linalg.solve(bend + penalty * np.eye(FEATURES), gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    ordered = np.sort(scaled @ weights)
    place = len(worse)  # as many lie below the threshold as there are poor rows
    return Model(mean, scale, weights, float((ordered[place - 1] + ordered[place]) / 2))


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each id and label in a task: the features of its text with the least digest."""
    least: dict[tuple, tuple[int, list[float]]] = {}
    kind = None
    for batch in slices(batches, "text"):
        kind = batch.schema.field("id").type
        names = ("id", "good", "digest", "text")
        for i, good, digest, text in zip(*(batch.column(x).to_pylist() for x in names)):
            if (i, good) not in least or digest < least[i, good][0]:
                least[i, good] = digest, features(text).tolist()
    if least:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in least], kind), pa.array([good for _, good in least]),
                pa.array([digest for digest, _ in least.values()], pa.int64()),
                pa.array([row for _, row in least.values()], pa.list_(pa.float64())),
            ],
            ["id", "good", "digest", "row"],
        )


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", most: int = MOST_LABELLED,
) -> Model:
    """A model from `labels` (id, 0 or 1), of which `most` at most are used.

    Rows without id or label teach nothing. The ids chosen number `most` at most, so they are
    sent to all tasks and only labelled texts are read further; the driver gets their features.
    A label given twice counts once, and of an id with several rows the text with the least
    digest counts once, so the driver gets `most` rows at most, whatever is repeated.
    """
    chosen = (
        labels.select(F.col(id_column).alias("id"), (F.col(label_column) > 0).alias("good"))
        .where("id IS NOT NULL AND good IS NOT NULL").distinct()
        .orderBy(F.xxhash64("id"), "id", "good").limit(most)
    )
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    labelled = texts.join(F.broadcast(chosen), "id").select(
        "id", "good", F.xxhash64("text").alias("digest"), "text"
    )
    schema = T.StructType([
        labelled.schema["id"], T.StructField("good", T.BooleanType()),
        T.StructField("digest", T.LongType()), T.StructField("row", T.ArrayType(T.DoubleType())),
    ])
    table = (
        labelled.mapInArrow(_features_of, schema)
        .groupBy("id", "good").agg(F.min_by("row", "digest").alias("row"))
        .select("good", "row").toArrow()
    )
    if not table.num_rows:
        return fit(np.zeros((0, FEATURES)), np.zeros(0, dtype=bool))
    rows = np.array(table.column("row").to_pylist())
    good = table.column("good").to_numpy()
    order = np.lexsort((*rows.T, good))  # the same model whichever task ends first
    return fit(rows[order], good[order])


def _scorer(model: Model, text: str, score: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            rows = np.array([features(x) for x in texts]).reshape(len(texts), FEATURES)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.scores(rows))], [*batch.schema.names, score]
            )

    return run


def with_score(
    docs: DataFrame, model: Model, text_column: str = "text", score_column: str = "score"
) -> DataFrame:
    """`docs` with the score of each row's text, 0 to 1; `score_column` must be a new name."""
    schema = T.StructType([*docs.schema.fields, T.StructField(score_column, T.DoubleType())])
    return docs.mapInArrow(_scorer(model, text_column, score_column), schema)


def accepted(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of `docs` that the model does not reject, with the columns of `docs`."""
    score = fresh(docs, "score")
    return with_score(docs, model, text_column, score).where(F.col(score) >= CUT).drop(score)


def for_learning(labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The labels that may be learned from: one in five ids is held out."""
    return labels.where(F.crc32(F.col(id_column).cast("string")) % 5 != 0)
