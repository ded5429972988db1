"""Quality classifier: regularised quadratic discriminant analysis.

A document is a vector of transformed statistics (lengths, ratios, repeated
words and lines), all computed by built-in expressions. Each class is a
normal distribution: its mean and covariance come from one grouped aggregate
of sums and products over all labelled training rows (two rows of some
hundred numbers reach the driver, however many documents there are). Every
covariance is shrunk towards the pooled one, and both towards the pooled
diagonal, so that a statistic that never varies in a class stays usable. The
inverse Cholesky factors are computed once and compiled into one projection:
the score is the logistic of the difference of the log densities, each a
squared Mahalanobis length plus the log determinant, plus the log odds of the
classes.

Defined results: null or empty texts have the statistics of no words and are
scored like any other; texts are read whole, however long; an empty table
gives an empty result; other columns pass; unlabelled rows, rows with a null label and held-out
rows are not learned from; if a class has no training row every score is the
share of the other (0.5 without any row); repeated rows count as often as
they occur; a label table that repeats an id counts each of its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.llm.quality_rules import measured

PREDICT_AT = 0.7
SHRINK_CLASS = 0.1  # towards the pooled covariance
SHRINK_DIAGONAL = 0.1  # of that towards its diagonal
FLOOR = 1e-4  # least variance of a statistic

_N = "greatest(n_words, 1)"
# name -> SQL expression over the measures and __x, the text
STATISTICS = {
    "log_words": "ln(1D + n_words)",
    "word_length": f"ln(1D + word_chars / {_N})",
    "symbols": f"ln(1D + 20D * n_symbols / {_N})",
    "repeats": f"sqrt(n_repeat_words / {_N})",
    "dup_lines": "sqrt(n_dup_lines / greatest(n_lines, 1))",
    "stop_words": f"sqrt(n_stop_words / {_N})",
    "capitals": "sqrt((length(__x) - length(translate(__x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) "
    "/ greatest(word_chars, 1))",
    "shouts": f"ln(1D + 20D * (length(__x) - length(translate(__x, '!?', ''))) / {_N})",
    "digits": "sqrt((length(__x) - length(translate(__x, '0123456789', ''))) / greatest(word_chars, 1))",
    "stops": f"sqrt((length(__x) - length(translate(__x, '.,', ''))) / {_N})",
    "line_words": "ln(1D + n_words / greatest(n_lines, 1))",
}


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``stats`` (array of double) instead of the text; an input
    column of that name is replaced."""
    rows = df.withColumn("__x", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    keep = [c for c in df.columns if c not in (text, "stats")]
    vector = F.expr("array(" + ", ".join(f"CAST({e} AS DOUBLE)" for e in STATISTICS.values()) + ")")
    others = [F.col(f"`{c}`") for c in keep]
    return measured(rows.select(F.struct(*others).alias("__row"), "__x"), "__x").select(
        "__row.*", vector.alias("stats")
    )


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors (lower) and log determinants by class;
    ``log_odds`` of class 1."""

    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    log_dets: tuple[float, ...]
    log_odds: float

    def score(self, stats: str = "stats") -> str:
        """SQL expression of the chance of class 1."""
        if not self.means:
            return f"{float(1 / (1 + np.exp(-self.log_odds)))!r}D"

        def density(k: int) -> str:
            mean, inv = self.means[k], self.factors[k]
            centred = [f"({stats}[{i}] - ({float(m)!r}D))" for i, m in enumerate(mean)]
            rows = []
            for i in range(len(mean)):
                z = " + ".join(f"({float(inv[i, j])!r}D) * {centred[j]}" for j in range(i + 1))
                rows.append(f"pow({z}, 2)")
            return f"(({float(self.log_dets[k])!r}D) + " + " + ".join(rows) + ")"

        # far from both classes the exponential saturates at 0 or 1
        return f"1D / (1D + exp(0.5D * ({density(1)} - {density(0)}) - ({float(self.log_odds)!r}D)))"


def fit(rows: DataFrame, label: str = "label", stats: str = "stats") -> Discriminant:
    """From rows with ``label`` 0 or 1 and ``stats``."""
    d = len(STATISTICS)
    sums = [F.sum(F.expr(f"{stats}[{i}]")).alias(f"s{i}") for i in range(d)]
    products = [
        F.sum(F.expr(f"{stats}[{i}] * {stats}[{j}]")).alias(f"p{i}_{j}") for i in range(d) for j in range(i + 1)
    ]
    found = rows.filter(f"{label} IN (0, 1)").groupBy(label).agg(F.count("*").alias("n"), *sums, *products).collect()
    by = {int(r[label]): r for r in found}
    if len(by) < 2:
        return Discriminant((), (), (), 0.0 if not by else (30.0 if 1 in by else -30.0))
    means, covs, counts = [], [], []
    for k in (0, 1):
        r, n = by[k], by[k]["n"]
        mean = np.array([r[f"s{i}"] for i in range(d)]) / n
        second = np.empty((d, d))
        for i in range(d):
            for j in range(i + 1):
                second[i, j] = second[j, i] = r[f"p{i}_{j}"] / n
        means.append(mean)
        covs.append(second - np.outer(mean, mean))
        counts.append(n)
    pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / sum(counts)
    diagonal = np.diag(np.maximum(np.diag(pooled), FLOOR))
    factors, log_dets = [], []
    for cov in covs:
        shrunk = (1 - SHRINK_CLASS) * cov + SHRINK_CLASS * pooled
        shrunk = (1 - SHRINK_DIAGONAL) * shrunk + SHRINK_DIAGONAL * diagonal
        lower = np.linalg.cholesky(shrunk + FLOOR * np.eye(d))
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * float(np.log(np.diag(lower)).sum()))
    return Discriminant(tuple(means), tuple(factors), tuple(log_dets), float(np.log(counts[1] / counts[0])))


HELD_OUT = "coalesce(crc32(CAST(doc_id AS STRING)) % 4 = 2, false)"


def op7_quality_discriminant(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    known = stored(statistics(docs).withColumn("held_out", F.expr(HELD_OUT)), "quality-stats")
    rows = known.filter("NOT held_out").join(labels, "doc_id")
    model = fit(rows.select(F.col("quality").alias("label"), "stats"))
    return known.withColumn("score", F.expr(model.score())).select(
        "doc_id", "held_out", "score", F.expr(f"CAST(score >= {PREDICT_AT}D AS INT)").alias("predicted")
    )


QUERIES = {"op7_quality_discriminant": op7_quality_discriminant}
ORACLE = {}
