"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a vector of transformed statistics (lengths, character-class
shares, repetition, compressibility). Class means and covariances are sums over
all labelled training rows; each covariance is shrunk towards the pooled one and
then towards its diagonal. Scores are differences of Mahalanobis log densities,
computed with Cholesky factors made once on the driver (a few hundred numbers,
whatever the input).

Defined results: a null or empty text has all-zero statistics and is scored like
any other; rows without label, with a null label or a label other than 0 and 1
train nothing; with one class only, scores are 1 (only label 1) or 0 (only label
0); without any labelled row every score is 0.5. Repeated rows are scored each;
repeated labels count each. Extra columns are ignored by ``score_documents`` and
kept by ``with_score``.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import doc_columns, id_crc32, written

FEATURES = ("words", "word_length", "upper", "digits", "punctuation", "symbols", "non_ascii", "distinct_words",
            "top_word", "same_as_previous", "distinct_lines", "line_words", "distinct_sentences",
            "compressed", "word_endings", "exclamations", "spaces")
THRESHOLD = 0.3
HELD_OUT_MOD = 5
TO_POOLED, TO_DIAGONAL, RIDGE = 0.02, 0.02, 1e-4

_PUNCTUATION = np.frombuffer(b".,;:'\"?-()", dtype=np.uint8)
_SYMBOLS = np.frombuffer(b"!#$%&*@^~<>|=+_{}[]\\/`", dtype=np.uint8)


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one UTF-8 text (whole; empty: zeros)."""
    n = len(text)
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    hist = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    letters = max(1, int(hist[65:91].sum() + hist[97:123].sum() + hist[128:].sum()))
    w = len(words)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    sentences = [x for x in text.split(b". ") if x]
    share = np.sqrt
    top = max(counts.values())
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [
        float(np.log1p(w)),
        float(np.log1p(n / w)),
        float(share(hist[65:91].sum() / letters)),
        float(share(hist[48:58].sum() / n)),
        float(share(hist[_PUNCTUATION].sum() / n)),
        float(share(hist[_SYMBOLS].sum() / n)),
        float(share(hist[128:].sum() / n)),
        float(np.log(len(counts) / w)),
        float(share(top / w)),
        float(share(same / w)),
        float(np.log(len(set(lines)) / max(1, len(lines)))),
        float(np.log1p(w / max(1, len(lines)))),
        float(np.log(len(set(sentences)) / max(1, len(sentences)))),
        float(np.log(len(zlib.compress(text, 1)) / n)),
        float(share(sum(x[-1] in _ENDINGS for x in words) / w)),
        float(np.log1p(hist[33])),
        float(share(hist[[9, 10, 11, 12, 13, 32]].sum() / n)),
    ]


_ENDINGS = frozenset(b"!#$%&*@^~<>|=+_{}[]\\/`")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(b"" if x is None else bytes(x)) for x in texts], dtype=object)


def document_statistics(docs: DataFrame, text: str = "text") -> Column:
    return statistics_of(F.col(text).cast("string").cast("binary"))


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors, log-determinants and log priors by class (0, 1)."""

    means: tuple
    factors: tuple
    logdets: tuple
    log_priors: tuple
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of statistics."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logp = []
        for mean, factor, logdet, prior in zip(self.means, self.factors, self.logdets, self.log_priors, strict=True):
            z = (x - mean) @ factor.T
            logp.append(prior - 0.5 * logdet - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1.0 / (1.0 + np.exp(-np.clip(logp[1] - logp[0], -500.0, 500.0)))


def _class_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: sums of (1, x) (1, x)^T for each class, one cell a row."""
    f = len(FEATURES) + 1
    sums = np.zeros((2, f, f))
    for b in batches:
        if not b.num_rows:
            continue
        x = np.stack(b.column("features").to_numpy(zero_copy_only=False))
        x = np.hstack([np.ones((len(x), 1)), x])
        y = b.column("quality").to_numpy(zero_copy_only=False)
        for c in (0, 1):
            sums[c] += x[y == c].T @ x[y == c]
    cells = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(sums.ravel()[cells])], names=["cell", "value"])


def fit(training: DataFrame) -> Discriminant:
    """Discriminant from rows (features array<double>, quality 0/1): all of them.

    Sums are added per task, then per cell: at most 2 x 18 x 18 numbers reach
    the driver, however many rows there are.
    """
    f = len(FEATURES) + 1
    sums = np.zeros(2 * f * f)
    cells = training.select("features", F.col("quality").cast("int").alias("quality")) \
        .mapInArrow(_class_sums, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    for r in cells.collect():
        sums[r["cell"]] = r["value"]
    sums = sums.reshape(2, f, f)
    n = sums[:, 0, 0]
    if n.min() == 0:
        return Discriminant((), (), (), (), 0.5 if n.sum() == 0 else float(n[1] > 0))
    means = sums[:, 0, 1:] / n[:, None]
    scatter = [sums[c, 1:, 1:] - n[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / n.sum()
    factors, logdets = [], []
    for c in (0, 1):
        # few rows lean more on the pooled covariance
        to_pooled = max(TO_POOLED, f / (f + n[c]))
        cov = (1 - to_pooled) * scatter[c] / n[c] + to_pooled * pooled
        cov = (1 - TO_DIAGONAL) * cov + TO_DIAGONAL * np.diag(np.diag(cov)) + RIDGE * np.eye(f - 1)
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        logdets.append(2 * float(np.log(np.diag(low)).sum()))
    return Discriminant(tuple(means), tuple(factors), tuple(logdets), tuple(np.log(n / n.sum())))


def train(features: DataFrame, labels: DataFrame, held_out_mod: int = HELD_OUT_MOD) -> Discriminant:
    """Fit on the labelled rows of ``features`` (doc_id, features) whose
    crc32(doc_id) leaves a remainder other than 0."""
    known = doc_columns(labels, {"doc_id": "doc_id", "quality": "quality"}) \
        .filter(F.col("quality").isin(0, 1) & (id_crc32() % held_out_mod != 0))
    return fit(features.select("doc_id", "features").join(known, "doc_id"))


def score_udf(model: Discriminant):
    """Column function: statistics -> probability of label 1."""

    @F.pandas_udf(T.DoubleType())
    def score(features: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(features.to_numpy())) if len(features) else [], dtype=float)

    return score


def text_score_udf(model: Discriminant):
    """Column function: UTF-8 text -> probability of label 1."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        rows = [statistics(b"" if x is None else bytes(x)) for x in texts]
        return pd.Series(model.scores(np.array(rows)) if rows else [], dtype=float)

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    The texts are read once: their statistics are written (some 150 bytes a
    document), and both the training join and the scores read that table.
    """
    d = doc_columns(docs, {"doc_id": "doc_id", "text": "text"})
    features = written(d.select("doc_id", document_statistics(d).alias("features")))
    model = train(features, labels)
    return features.select("doc_id", (id_crc32() % HELD_OUT_MOD == 0).alias("held_out"),
                           score_udf(model)("features").alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose predicted label is 1.

    Training reads the statistics of the labelled documents only; the filter
    scores each text where it is read, so no document is shuffled.
    """
    known = doc_columns(labels, {"_label_id": "doc_id"}).filter(F.col("_label_id").isNotNull()).distinct()
    d = doc_columns(docs, {"doc_id": "doc_id", "text": "text"})
    features = written(d.select("doc_id", document_statistics(d).alias("features"))
                       .join(known, F.col("doc_id") == F.col("_label_id"), "left_semi"))
    score = text_score_udf(train(features, labels))
    return docs.filter(score(F.col("`text`").cast("string").cast("binary")) >= THRESHOLD)
