"""Quality classifier: a regularised quadratic discriminant on document statistics.

Each text becomes a short vector of transformed statistics (shares of capital
letters, symbols, repeated words and so on). Means and covariances of both
classes are one distributed aggregation over every labelled row. Each class
covariance is shrunk towards the pooled one and that towards its diagonal; its
Cholesky factor is computed once and sent with the task. A text's score is the
logistic of the difference of both log densities (Mahalanobis distance plus log
determinant) and priors.

Defined cases: null and empty texts have the statistics of a text without words
and are scored like any other. Label rows whose quality is null or not 0 or 1
are ignored; a document with several label rows counts once for each. With
labels of one class only, the score is that class; with none it is 0.5. Repeated
documents are scored row by row. Extra columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from logweave.llm.storage import free_name, remainder, staged
from logweave.llm.text import slices, text_bytes, word_codes, word_spans

#: Weight of the pooled covariance in each class, and of its diagonal in the pooled one.
SHRINK_CLASS, SHRINK_DIAGONAL = 0.1, 0.2
#: Variance added to every statistic.
RIDGE = 1e-4
THRESHOLD = 0.3

UPPER, LOWER, DIGIT, BANG, BAR, SYMBOL, PUNCT, SPACE, LINE, WIDE = range(10)
STATISTICS = ("words", "word_length", "capitals", "digits", "bangs", "bars", "symbols", "punctuation",
              "wide", "lines", "repeats", "distinct", "longest_line")


def _kinds() -> np.ndarray:
    kind = np.full(256, PUNCT, np.int64)
    kind[65:91], kind[97:123], kind[48:58] = UPPER, LOWER, DIGIT
    kind[ord("!")], kind[ord("|")] = BANG, BAR
    kind[list(b"#$%&*@^~<>{}[]=+_\\`")] = SYMBOL
    kind[[32, 9, 11, 12, 13]], kind[10], kind[128:] = SPACE, LINE, WIDE
    return kind


KIND = _kinds()


def statistics(column: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each text."""
    raw, begins = text_bytes(column)
    n = len(column)
    owner = np.repeat(np.arange(n), np.diff(begins))
    kinds = np.bincount(owner * 10 + KIND[raw], minlength=n * 10).reshape(n, 10).astype(float)
    start, end, doc = word_spans(raw, begins)
    words = np.bincount(doc, minlength=n).astype(float)
    per_word = np.maximum(words, 1)
    repeats = distinct = np.zeros(n)
    if len(start):
        code, vocabulary = word_codes(raw, start, end)
        again = (code[1:] == code[:-1]) & (doc[1:] == doc[:-1])
        repeats = np.bincount(doc[1:][again], minlength=n)
        distinct = np.bincount(np.unique(doc * len(vocabulary) + code) // len(vocabulary), minlength=n)
    letters = np.maximum(kinds[:, UPPER] + kinds[:, LOWER] + kinds[:, WIDE], 1)
    held = kinds.sum(1) - kinds[:, SPACE] - kinds[:, LINE]
    breaks = np.flatnonzero(raw == 10)
    edges = np.union1d(breaks + 1, begins)
    span = np.diff(edges)
    widest = np.zeros(n)
    np.maximum.at(widest, np.searchsorted(begins, edges[:-1], side="right") - 1, span)
    share = lambda count, total: np.sqrt(count / total)
    return np.column_stack([
        np.log1p(words), np.log1p(held / per_word), share(kinds[:, UPPER], letters),
        *(share(kinds[:, k], per_word) for k in (DIGIT, BANG, BAR, SYMBOL, PUNCT)),
        share(kinds[:, WIDE], letters), share(kinds[:, LINE], per_word),
        share(repeats, per_word), distinct / per_word, np.log1p(widest),
    ])


@dataclass(frozen=True)
class Discriminant:
    """For each class with rows: mean, inverse Cholesky factor, log determinant and log prior."""

    classes: dict[int, tuple[np.ndarray, np.ndarray, float, float]]

    def score(self, x: np.ndarray) -> np.ndarray:
        if len(self.classes) < 2:
            return np.full(len(x), float(next(iter(self.classes), 0.5)))
        density = {}
        for label, (mean, whiten, logdet, prior) in self.classes.items():
            density[label] = prior - 0.5 * (((x - mean) @ whiten.T) ** 2).sum(1) - 0.5 * logdet
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def statistics_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every row of ``docs``."""
    pair = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = statistics(part.column("text"))
            yield pa.record_batch([part.column("doc_id"), pa.array(list(rows), pa.list_(pa.float64()))], ["doc_id", "x"])

    return pair.mapInArrow(of, f"doc_id {pair.schema['doc_id'].dataType.simpleString()}, x array<double>")


def fit(table: DataFrame, labels: DataFrame, learn: Column) -> Discriminant:
    """Class moments over every labelled row of ``table`` for which ``learn`` (on doc_id) holds."""
    d = len(STATISTICS)
    marked = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & learn)
    x = [F.col("x")[i] for i in range(d)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    sums += [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    rows = table.join(marked, "doc_id").groupBy(F.col("quality").cast("int").alias("label")).agg(F.count("*").alias("n"), *sums).collect()
    moments = {}
    for r in rows:
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        product = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                product[i, j] = product[j, i] = r[f"p{i}_{j}"] / r["n"]
        moments[r["label"]] = (r["n"], mean, product - np.outer(mean, mean))
    total = sum(n for n, _, _ in moments.values())
    if not total:
        return Discriminant({})
    pooled = sum(n * cov for n, _, cov in moments.values()) / total
    pooled = (1 - SHRINK_DIAGONAL) * pooled + SHRINK_DIAGONAL * np.diag(np.diag(pooled))
    classes = {}
    for label, (n, mean, cov) in moments.items():
        factor = np.linalg.cholesky((1 - SHRINK_CLASS) * cov + SHRINK_CLASS * pooled + RIDGE * np.eye(d))
        classes[label] = (mean, np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum()), float(np.log(n / total)))
    return Discriminant(classes)


def scored_table(table: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score) from a statistics table."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            yield pa.record_batch([b.column("doc_id"), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    return table.mapInArrow(of, f"doc_id {table.schema['doc_id'].dataType.simpleString()}, score double")


def with_score(docs: DataFrame, model: Discriminant, into: str, text_column: str = "text") -> DataFrame:
    """``docs`` with all its columns, and each row's score as column ``into``."""
    schema = StructType([*docs.schema.fields, StructField(into, DoubleType())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_column):
            score = model.score(statistics(part.column(text_column)))
            yield pa.record_batch([*part.columns, pa.array(score, pa.float64())], [*part.schema.names, into])

    return docs.mapInArrow(of, schema)


def learned(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Discriminant]:
    """The statistics of all documents, and the model of the labelled ones whose remainder isn't 0."""
    table = staged(statistics_table(docs), "quality-statistics")
    return table, fit(table, labels, remainder("doc_id", 5) != 0)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    table, model = learned(docs, labels)
    return scored_table(table, model).select(
        "doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their own columns."""
    learn = remainder("doc_id", 5) != 0  # no other row's statistics are needed for the model
    model = fit(statistics_table(docs.where(learn)), labels, learn)
    name = free_name(docs, "quality_score")
    return with_score(docs, model, name).where(F.col(name) >= THRESHOLD).drop(name)
