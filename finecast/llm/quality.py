"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finecast.llm.shared import present, written

THRESHOLD = 0.7
#: Share of a class covariance that is replaced by the pooled one, and by a multiple of the unit matrix.
POOLED, ROUND = 0.15, 0.05
#: Standardised statistics further out than this count as this far out.
REACH = 8.0

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_STOPS = b".,;:?!"
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in b".,;:?!'\"()-|")

NAMES = (
    "words", "word_bytes", "upper", "digits", "symbols", "bars", "shouts", "stops", "variety", "top_word", "echoes",
    "short_words", "titles", "line_words", "line_variety", "line_ends",
)


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of one whole text; all are finite, also for empty texts."""
    text = text or b""
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    counts = Counter(words)
    size = len(text)

    def held(chars: bytes) -> int:
        return size - len(text.translate(None, chars))

    upper, lower, digits = held(_UPPER), held(_LOWER), held(_DIGIT)
    letters = sum(map(len, words)) - digits
    share = lambda a, b, s=1.0: math.log((a + 0.5 * s) / (b - a + s)) if b >= a else 0.0  # noqa: E731  smoothed log odds
    per_word = lambda k, s=20.0: math.log1p(s * k / (n + 1))
    return [
        math.log1p(n),
        math.log1p(letters / (n + 1)),
        share(upper, upper + lower, 4.0),
        per_word(digits),
        per_word(held(_SYMBOLS)),
        per_word(text.count(b"|")),
        per_word(text.count(b"!")),
        per_word(held(_STOPS)),
        math.log1p(len(counts)) - 0.8 * math.log1p(n),
        share(max(counts.values(), default=0), n, 8.0),
        per_word(sum(map(eq, words, words[1:]))),
        share(sum(len(w) <= 3 for w in words), n, 8.0),
        share(sum(65 <= w[0] <= 90 for w in words), n, 8.0),
        math.log1p(n / (len(lines) + 1)),
        share(len(lines) - len(set(lines)), len(lines) + 1, 2.0),
        share(sum(x.rstrip()[-1:] in (b".", b"?", b"!") for x in lines), len(lines) + 1, 1.0),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(text: pd.Series) -> pd.Series:
    return pd.Series([statistics(x) for x in text])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


@dataclass(frozen=True)
class Discriminant:
    """Fitted state; its size depends on the number of statistics alone."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    offsets: tuple[float, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for rows of statistics."""
        if not self.means:
            return np.full(len(x), self.offsets[0])
        z = np.clip((x - self.centre) / self.scale, -REACH, REACH)
        density = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True):
            far = np.linalg.solve(factor, (z - mean).T)
            density.append(offset - 0.5 * (far * far).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -60, 60)))


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sums and products per class of ``rows`` (y, x), added up by Spark; the driver gets a fixed number of values."""
    d = len(NAMES)

    def partial(batches):
        total = {}
        for b in batches:
            for y, part in b.groupby("y"):
                x = np.hstack([np.ones((len(part), 1)), np.array(part["x"].tolist()).reshape(len(part), d)])
                total[y] = total.get(y, 0) + x.T @ x
        for y, m in total.items():
            yield pd.DataFrame({"y": y, "k": np.arange(m.size), "v": m.ravel()})

    sums = rows.mapInPandas(partial, "y int, k int, v double").groupBy("y", "k").agg(F.sum("v").alias("v")).orderBy("y", "k").collect()
    out = {}
    for y in {r["y"] for r in sums}:
        m = np.array([r["v"] for r in sums if r["y"] == y]).reshape(d + 1, d + 1)
        out[y] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return out


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> Discriminant:
    """Fit on every labelled document that is not held out.

    Statistics of all documents are written once (a few numbers a row) and
    joined to the labels; texts are not shuffled.  Class covariances over the
    standardised statistics are shrunk towards the pooled one and the unit
    matrix, and their Cholesky factors kept.  Labels other than 0 and 1 and
    labels without a document are ignored; a repeated label counts as often as
    it stands.  With one class only every score is 1 or 0 accordingly, with no
    label at all 0.5.
    """
    stats = docs.where(~held_out(F.col(doc_id))).select(F.col(doc_id).alias("i"), _statistics(present(F.col(text)).cast("binary")).alias("x"))
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y"))
    parts = moments(written(stats, "statistics").join(known, "i").select("y", "x"))
    none = np.zeros(0)
    if len(parts) < 2:
        return Discriminant(none, none, (), (), (float(next(iter(parts))) if parts else 0.5,))
    n = sum(p[0] for p in parts.values())
    centre = sum(p[1] for p in parts.values()) / n
    spread = np.diag(sum(p[2] for p in parts.values())) / n - centre**2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    means, covs = [], []
    for y in (0, 1):
        k, s, ss = parts[y]
        mean = s / k
        covs.append((ss / k - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - centre) / scale)
    pooled = sum(parts[y][0] * covs[y] for y in (0, 1)) / n
    factors, offsets = [], []
    for y in (0, 1):
        cov = (1 - POOLED) * covs[y] + POOLED * pooled
        cov = (1 - ROUND) * cov + ROUND * max(np.trace(pooled) / len(centre), 1e-3) * np.eye(len(centre))
        factor = np.linalg.cholesky(cov)
        factors.append(factor)
        offsets.append(float(np.log(parts[y][0] / n) - np.log(np.diag(factor)).sum()))
    return Discriminant(centre, scale, tuple(means), tuple(factors), tuple(offsets))


def score(docs: DataFrame, model: Discriminant, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with ``held_out``, ``score`` and ``predicted`` (replacing columns of these names).

    Only the text enters a score.  Null text counts as empty; repeated rows get
    equal scores; an empty table gives no rows.
    """

    @F.pandas_udf("double")
    def scored(body: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([statistics(x) for x in body]).reshape(len(body), len(NAMES))))

    out = docs.drop("held_out", "score", "predicted").withColumn("score", scored(present(F.col(text)).cast("binary")))
    return out.withColumn("held_out", held_out(F.col(doc_id))).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels)).select("doc_id", "held_out", "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the classifier accepts, with the columns they came with."""
    return score(docs, fit(docs, labels)).where("predicted = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
