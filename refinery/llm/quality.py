"""Document quality by a regularised quadratic discriminant.

Statistics of a document's text are transformed to be roughly normal. Each class is a normal
distribution whose covariance is shrunk towards the pooled one and towards its diagonal; the
score is the posterior from the difference of the log densities. Means and covariances come
from sums over all labelled documents, the Cholesky factors are kept in the model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import ROWS, column_named, forget, stored, text_column

FEATURES = (
    "log_bytes", "log_words", "word_length", "word_spread", "longest_word", "distinct_words", "top_word", "upper",
    "digits", "symbols", "stops", "exclaims", "pipes", "beyond_ascii", "spaces", "entropy", "line_length",
    "repeated_lines", "capital_words", "symbol_words",
)
_BYTES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "symbols": b"#$%&*@^~_=+<>/\\[]{}",
    "stops": b".,;:",
    "exclaims": b"!?",
    "pipes": b"|",
    "spaces": b" \t\n\r",
}
_SYMBOL_END = frozenset(b"#$%&*@^~_=+<>/\\|!")


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text, in the order of ``FEATURES``."""
    raw = text.encode("utf-8", "replace")
    n = len(raw)
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n_words = len(words)
    lengths = np.fromiter(map(len, words), np.float64, n_words) if words else np.zeros(1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x]

    def share(part: float, whole: float) -> float:
        """Log odds, smoothed so that none and all are finite."""
        return math.log((part + 0.5) / (whole - part + 0.5))

    total = {k: float(histogram[list(v)].sum()) for k, v in _BYTES.items()}
    p = histogram[histogram > 0] / max(1, n)
    capital = sum(w.isupper() for w in counts)
    symbol = sum(w[-1] in _SYMBOL_END for w in counts)
    return [
        math.log1p(n), math.log1p(n_words), math.log1p(lengths.mean()), math.log1p(lengths.std()), math.log1p(lengths.max()),
        share(len(counts), n_words), share(max(counts.values(), default=0), n_words),
        share(total["upper"], n), share(total["digits"], n), share(total["symbols"], n), share(total["stops"], n),
        share(total["exclaims"], n), share(total["pipes"], n), share(float(histogram[128:].sum()), n),
        share(total["spaces"], n), float(-(p * np.log(p)).sum()), math.log1p(n / max(1, len(lines))),
        share(len(lines) - len(set(lines)), len(lines)), share(capital, len(counts)), share(symbol, len(counts)),
    ]


def document_statistics(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Returns the id column and ``stats`` (array of double) of every row's whole text."""
    source = docs.select(column_named(docs, id_column).alias(id_column), text_column(docs, text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                stats = [statistics(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(stats, pa.list_(pa.float64()))], [id_column, "stats"])

    return source.mapInArrow(run, f"`{id_column}` {source.schema[0].dataType.simpleString()}, stats array<double>")


@dataclass
class Discriminant:
    """Means, lower Cholesky factors of the covariances and log priors of classes 0 and 1."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_priors: list[float]
    log_determinants: list[float]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1 for every row."""
        logs = []
        for mean, factor, prior, determinant in zip(self.means, self.factors, self.log_priors, self.log_determinants):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(prior - 0.5 * ((z * z).sum(0) + determinant))
        gap = np.clip(logs[1] - logs[0], -700, 700)
        return 1.0 / (1.0 + np.exp(-gap))


def _fit(sums: dict[int, np.ndarray], towards_pooled: float, towards_diagonal: float) -> Discriminant | float:
    """The model, or a constant score where a class has no labelled document."""
    d = len(FEATURES)
    n = {c: sums[c][0] if c in sums else 0.0 for c in (0, 1)}
    if not n[0] or not n[1]:
        return 0.0 if n[0] else 1.0
    means = {c: sums[c][1 : d + 1] / n[c] for c in n}
    scatter = {c: sums[c][d + 1 :].reshape(d, d) - n[c] * np.outer(means[c], means[c]) for c in n}
    pooled = (scatter[0] + scatter[1]) / (n[0] + n[1])
    floor = 1e-3 * max(float(np.trace(pooled)) / d, 1e-6)
    factors, determinants = [], []
    for c in (0, 1):
        mixed = (1 - towards_pooled) * scatter[c] / n[c] + towards_pooled * pooled
        shrunk = (1 - towards_diagonal) * mixed + towards_diagonal * np.diag(np.diag(mixed)) + floor * np.eye(d)
        factors.append(np.linalg.cholesky((shrunk + shrunk.T) / 2))
        determinants.append(2 * float(np.log(np.diag(factors[-1])).sum()))
    priors = [math.log(n[c] / (n[0] + n[1])) for c in (0, 1)]
    return Discriminant([means[0], means[1]], factors, priors, determinants)


def fit_quality(
    stats: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    label: str = "quality",
    towards_pooled: float = 0.1,
    towards_diagonal: float = 0.02,
) -> Discriminant | float:
    """Fits on all rows of ``labels`` with label 0 or 1 whose id has statistics.

    Sums of the statistics and of their products are added up on the executors; what comes to
    the driver has a fixed size. Null ids and null or other labels are left out; a repeated
    label counts each time. Without a document of one class the score is constant: the label
    of the other class, and 1 without any label.
    """
    kept = labels.select(
        column_named(labels, id_column).alias("__id"), column_named(labels, label).cast("int").alias("__label")
    ).where("__label in (0, 1)")
    joined = stats.join(kept, F.col(id_column) == F.col("__id")).select("__label", "stats")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        d = len(FEATURES)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column(1).flatten()).reshape(-1, d)
            y = np.asarray(batch.column(0))
            for c in np.unique(y).tolist():
                own = x[y == c]
                part = np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
                sums[c] = sums[c] + part if c in sums else part
        for c, s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * len(s), pa.int32()), pa.array(range(len(s)), pa.int32()), pa.array(s)], ["label", "k", "v"]
            )

    rows = joined.mapInArrow(add, "label int, k int, v double").groupBy("label", "k").agg(F.sum("v")).collect()
    size = 1 + len(FEATURES) + len(FEATURES) ** 2
    sums = {c: np.zeros(size) for c in {r[0] for r in rows}}
    for c, k, v in rows:
        sums[c][k] = v
    return _fit(sums, towards_pooled, towards_diagonal)


def score_quality(stats: DataFrame, model: Discriminant | float, id_column: str = "doc_id") -> DataFrame:
    """Returns the id column and ``score`` (0 to 1; higher: label 1 is likelier)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column(1).flatten()).reshape(-1, len(FEATURES))
            score = model.score(x) if isinstance(model, Discriminant) else np.full(len(x), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], [id_column, "score"])

    kind = stats.schema[id_column].dataType.simpleString()
    return stats.select(id_column, "stats").mapInArrow(run, f"`{id_column}` {kind}, score double")


def classify(
    docs: DataFrame, labels: DataFrame, held_out=None, id_column: str = "doc_id", text: str = "text", label: str = "quality", least: float = 0.7
) -> DataFrame:
    """Returns the id column, ``held_out``, ``score`` and ``predicted`` (1 if the score is
    ``least`` or more, else 0) of every row of ``docs``.

    ``held_out`` makes, from the id column, the boolean column of the rows whose labels are
    not learned; none by default. Only the text makes the score: null and empty texts have
    one too. Repeated rows are repeated, null ids are scored but never learned from, an empty
    table stays empty.
    """
    stats = stored(document_statistics(docs, id_column, text), "quality-stats")
    apart = (lambda c: F.coalesce(held_out(c), F.lit(False))) if held_out else (lambda c: F.lit(False))
    model = fit_quality(stats, labels.where(~apart(column_named(labels, id_column))), id_column, label)
    return score_quality(stats, model, id_column).select(
        id_column,
        apart(F.col(f"`{id_column}`")).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )
