"""Quality classifier: regularised quadratic discriminant analysis.

A text is described by transformed statistics of its characters, words and
lines. Each class (label 1, label 0) has a mean and a covariance of them,
shrunk towards a multiple of the identity; the score of a text is the
difference of the two Gaussian log-densities (Mahalanobis distances by the
cached Cholesky factors, log-determinants, log-priors), put through a logistic
function. All sums over the labelled rows are partial aggregates in Spark; the
driver sees two means and two covariances, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from raceline.llm.common import Scratch

# Byte classes (fixed values).
_SPACE, _DIGIT, _UPPER, _LOWER, _HIGH, _STOP, _MARK, _OTHER = range(8)
_CLASS = np.full(256, _OTHER, np.int64)
for _name, _bytes in (
    (_SPACE, b" \t\n\x0b\x0c\r"),
    (_DIGIT, b"0123456789"),
    (_UPPER, bytes(range(65, 91))),
    (_LOWER, bytes(range(97, 123))),
    (_HIGH, bytes(range(128, 256))),
    (_STOP, b".,;:'\"()-"),
    (_MARK, b"!?"),
):
    _CLASS[list(_bytes)] = _name

#: Words at which the statistics of a text count half.
RELIABLE_WORDS = 20

FEATURES = (
    "log_words",
    "log_lines",
    "word_length",
    "longest_word",
    "distinct_words",
    "distinct_lines",
    "short_words",
    "words_per_line",
    "digits",
    "upper",
    "non_ascii",
    "stops",
    "marks",
    "symbols",
    "symbol_ends",
    "symbol_words",
    "capital_words",
    "byte_entropy",
)


def features(text: str) -> np.ndarray:
    """The statistics of a text, most of them square roots of fractions and
    logarithms of counts. An empty text is all zeros."""
    data = text.encode()
    words = data.split()
    if not words:
        return np.zeros(len(FEATURES))
    raw = np.frombuffer(data, np.uint8)
    kinds = _CLASS[raw]
    counts = np.bincount(kinds, minlength=8)
    seen = max(1, len(raw) - counts[_SPACE])
    share = counts / seen
    space = kinds == _SPACE
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    ends = np.flatnonzero(~space & np.append(space[1:], True))
    lengths = ends - starts + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = len(words)
    odd_end = (kinds[ends] == _OTHER) | (kinds[ends] == _MARK)
    odd_start = kinds[starts] == _OTHER
    capital = (kinds[starts] == _UPPER) & (kinds[np.minimum(starts + 1, ends)] == _UPPER) & (lengths > 1)
    used = np.bincount(raw, minlength=256)
    used = used[used > 0] / len(raw)
    return np.array(
        [
            np.log1p(n),
            np.log1p(len(lines)),
            np.log(lengths.mean()),
            np.log(lengths.max()),
            np.sqrt(len(set(words)) / n),
            np.sqrt(len(set(lines)) / max(1, len(lines))),
            np.sqrt((lengths <= 3).mean()),
            np.log1p(n / max(1, len(lines))),
            np.sqrt(share[_DIGIT]),
            np.sqrt(share[_UPPER]),
            np.sqrt(share[_HIGH]),
            np.sqrt(share[_STOP]),
            np.sqrt(share[_MARK]),
            np.sqrt(share[_OTHER]),
            np.sqrt(odd_end.mean()),
            np.sqrt((odd_start & odd_end).mean()),
            np.sqrt(capital.mean()),
            float(-(used * np.log(used)).sum()),
        ]
    )


def feature_table(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``x`` (array of the statistics) of every row."""
    table = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["key", "x"])

    kind = table.schema["key"].dataType.simpleString()
    return table.mapInArrow(run, f"key {kind}, x array<double>").withColumnRenamed("key", key)


def standardised(x: np.ndarray, center: np.ndarray, scale: np.ndarray, clip: float) -> np.ndarray:
    """Statistics in units of their spread. Those of a few words say little:
    n words count for n / (n + RELIABLE_WORDS) of their distance."""
    words = np.expm1(x[:, :1])
    return np.clip((x - center) / scale, -clip, clip) * (words / (words + RELIABLE_WORDS))


def _moments(rows: DataFrame, center: np.ndarray | None, scale: np.ndarray | None, clip: float) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per label: rows, sum and sum of outer products of ``x`` (standardised
    and clipped if a center is given). Each task adds up its rows; the sums
    of the tasks are added by Spark, number by number."""
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {y: np.zeros(1 + d + d * d) for y in (0, 1)}
        for b in batches:
            x = np.asarray(b.column(1).flatten()).reshape(-1, d)
            if center is not None:
                x = standardised(x, center, scale, clip)
            label = np.asarray(b.column(0))
            for y in (0, 1):
                own = x[label == y]
                total[y] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        size = 1 + d + d * d
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], size)), pa.array(np.tile(np.arange(size), 2)), pa.array(np.concatenate([total[0], total[1]]))],
            names=["label", "i", "value"],
        )

    sums = rows.select("label", "x").mapInArrow(run, "label bigint, i bigint, value double").groupBy("label", "i").agg(F.sum("value").alias("value"))
    out = {y: np.zeros(1 + d + d * d) for y in (0, 1)}
    for r in sums.collect():  # two classes, 1 + d + d^2 numbers each
        out[r["label"]][r["i"]] = r["value"]
    return {y: (int(v[0]), v[1 : 1 + d], v[1 + d :].reshape(d, d)) for y, v in out.items()}


@dataclass(frozen=True)
class Discriminant:
    """A fitted classifier: what the scoring of a batch needs."""

    center: np.ndarray
    scale: np.ndarray
    clip: float
    means: tuple[np.ndarray, np.ndarray]
    whiten: tuple[np.ndarray, np.ndarray]  # inverse Cholesky factors of the covariances
    offsets: tuple[float, float]  # log-prior minus half the log-determinant
    temperature: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-density of label 1 minus that of label 0."""
        z = standardised(x, self.center, self.scale, self.clip)
        log = [o - 0.5 * (((z - m) @ w.T) ** 2).sum(1) for m, w, o in zip(self.means, self.whiten, self.offsets)]
        return log[1] - log[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x) / self.temperature, -700, 700)))


def fit(rows: DataFrame, shrinkage: float = 0.02, clip: float = 4.0, temperature: float = float(len(FEATURES))) -> Discriminant | None:
    """Fit on all rows of (label 0 or 1, x). None if a class has fewer than
    two rows."""
    d = len(FEATURES)
    raw = _moments(rows, None, None, clip)
    if min(raw[0][0], raw[1][0]) < 2:
        return None
    n = raw[0][0] + raw[1][0]
    center = (raw[0][1] + raw[1][1]) / n
    spread = np.diag(raw[0][2] + raw[1][2]) / n - center**2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    means, whiten, offsets = [], [], []
    for m, total, outer in (v for _, v in sorted(_moments(rows, center, scale, clip).items())):
        mean = total / m
        cov = outer / m - np.outer(mean, mean)
        cov = (1 - shrinkage) * cov + shrinkage * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        means.append(mean)
        whiten.append(np.linalg.inv(factor))
        offsets.append(float(np.log(m / n) - np.log(np.diag(factor)).sum()))
    return Discriminant(center, scale, clip, tuple(means), tuple(whiten), tuple(offsets), temperature)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels the fit never sees: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", shrinkage: float = 0.02) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier)
    and ``predicted`` (1 from a score of 0.5 on) of every document.

    The fit uses all labelled rows that are not held out; only statistics of
    the whole text enter. Null labels, and labels that contradict each other
    for one doc_id, are left out. Null texts are empty; empty texts are
    scored like others. Without two labelled rows of each class every score
    is 0.5. Repeated rows give repeated rows; an empty table none."""
    table, model = _fitted(docs, labels, text, shrinkage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = _scores(model, np.asarray(b.column(1).flatten()).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = table.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _scores(model: Discriminant | None, x: np.ndarray) -> np.ndarray:
    return model.score(x) if model else np.full(len(x), 0.5)


def _fitted(docs: DataFrame, labels: DataFrame, text: str, shrinkage: float) -> tuple[DataFrame, Discriminant | None]:
    scratch = Scratch(docs.sparkSession, "quality")
    table = scratch.write(feature_table(docs, text), "features")
    agreed = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
    agreed = agreed.where("label = most and label in (0, 1)").select("doc_id", F.col("label").cast("long").alias("label"))
    return table, fit(table.where(~held_out()).join(agreed, "doc_id"), shrinkage)


def quality_rows(docs: DataFrame, labels: DataFrame, text: str = "text", shrinkage: float = 0.02) -> DataFrame:
    """The documents themselves with ``score`` and ``predicted`` (input
    columns of these names are replaced), as ``quality_scores`` defines them.
    The rows are scored where they are read, without a shuffle."""
    rows = docs.drop("score", "predicted")
    _, model = _fitted(docs, labels, text, shrinkage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text))
            x = np.array([features(t.as_py() or "") for t in texts]).reshape(-1, len(FEATURES))
            score = _scores(model, x)
            added = [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], names=[*b.schema.names, "score", "predicted"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())]))
