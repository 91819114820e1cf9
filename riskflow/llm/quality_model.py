"""Document quality by hierarchical empirical Bayes.

A logistic model on statistics of the whole text gives each document its own evidence.
Sites (a host, or another column) and paths within them have a share of good documents of
their own. These shares are estimated from the corpus: grouped sums of what is known
of their documents (the label, else the model's probability), shrunk towards the level
above, and the site level towards the corpus. How strongly is estimated too, from how
much the shares of sites differ beyond chance: sparse sites stay near the prior, large
ones speak for themselves. A document's posterior is its evidence on top of the share of
its path, from which its own contribution is taken out.

The model is fitted on at most `fit_rows` labelled documents, those with the smallest
hashes of their ids; all other sums run over all documents.

Defined results: NULL text is an empty one; NULL sites are a site of their own; NULL
labels are no labels; several labels of one document count by their mean; without labels
of both kinds the model says 0.5 for all; rows that repeat an id or have a NULL id are
judged each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.sources.tables import stored

FIT_ROWS = 20_000
THRESHOLD = 0.5
_CLASSES = np.zeros(256, np.uint8)  # 1 white, 2 upper, 3 lower or other letter, 4 digit, 5 sign
_CLASSES[:] = 5
_CLASSES[[0x20, *range(0x09, 0x0E)]] = 1
_CLASSES[65:91] = 2
_CLASSES[97:123] = 3
_CLASSES[128:] = 3
_CLASSES[48:58] = 4
_ORDINARY = np.zeros(256, bool)
_ORDINARY[[ord(c) for c in ".,;:'\"!?()-"]] = True
N_FEATURES = 10


def features(text: bytes) -> list[float]:
    """Statistics of a whole text that don't depend on its language."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return [0.0] * N_FEATURES
    kind = _CLASSES[data]
    counts = np.bincount(kind, minlength=6).astype(float)
    solid = max(1.0, len(data) - counts[1])
    signs = kind == 5
    ordinary = float(np.count_nonzero(signs & _ORDINARY[data]))
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    # How much is left of the text when repetitions are coded away, and of its words.
    packed = len(zlib.compress(text, 1)) / len(data)
    doubled = np.count_nonzero(data[1:] == data[:-1]) / len(data)
    return [
        np.log1p(len(words)),
        np.log1p(100 * (counts[5] - ordinary) / solid),
        np.log1p(100 * ordinary / solid),
        counts[2] / solid,
        counts[4] / solid,
        solid / n / 10,
        len(set(words)) / n,
        packed * min(1.0, len(data) / 500),
        1 - len(set(lines)) / max(1, len(lines)),
        doubled,
    ]


def with_features(docs: DataFrame) -> DataFrame:
    """`docs` (columns: text and others) with its text replaced by its features."""
    others = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            rows = [features(t.as_py() or b"") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(rows, pa.list_(pa.float64()))],
                [*others, "features"],
            )

    return docs.select(*others, "text").mapInArrow(measured, f"{schema}, features array<double>")


@dataclass(frozen=True)
class Evidence:
    """A fitted logistic model: log odds = bias + weights * (features - centre) / scale."""

    weights: np.ndarray
    bias: float
    centre: np.ndarray
    scale: np.ndarray

    def log_odds(self, column: str) -> Column:
        total = F.lit(float(self.bias))
        for i in range(len(self.weights)):
            centred = (F.col(column)[i] - float(self.centre[i])) / float(self.scale[i])
            # A statistic far outside what the model has seen counts as its border.
            bounded = F.least(F.greatest(centred, F.lit(-6.0)), F.lit(6.0))
            total = total + bounded * float(self.weights[i])
        return F.least(F.greatest(total, F.lit(-12.0)), F.lit(12.0))


def fit_evidence(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> Evidence:
    """Logistic regression by Newton steps, with a penalty on the weights."""
    n, p = x.shape
    centre = x.mean(axis=0) if n else np.zeros(p)
    scale = np.maximum(x.std(axis=0), 1e-3) if n else np.ones(p)
    if n == 0 or y.min() == y.max():
        return Evidence(np.zeros(p), 0.0, centre, scale)
    design = np.hstack([np.clip((x - centre) / scale, -6, 6), np.ones((n, 1))])
    penalty = np.diag([ridge] * p + [1e-6])
    beta = np.zeros(p + 1)
    for _ in range(rounds):
        mean = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - mean) - penalty @ beta
        hessian = (design * (mean * (1 - mean) + 1e-9)[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, gradient)
        beta += step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return Evidence(beta[:-1], float(beta[-1]), centre, scale)


def url_levels(url: str) -> dict[str, Column]:
    """Host and first path segment of a URL, as levels for `judge`."""
    host = F.lower(F.try_parse_url(F.col(url), F.lit("HOST")))
    path = F.split(F.try_parse_url(F.col(url), F.lit("PATH")), "/")
    return {"host": host, "path": F.get(path, F.lit(1))}


def _strength(mean: Column) -> Column:
    """Pseudo-documents of the prior: large if groups differ by no more than chance would."""
    share = F.col("good") / F.col("n")
    between = F.sum(F.col("n") * (share - mean) * (share - mean)) / F.sum("n")
    by_chance = mean * (1 - mean) * F.count(F.lit(1)) / F.sum("n")
    spread = F.greatest(between - by_chance, mean * (1 - mean) * 1e-4)
    strength = mean * (1 - mean) / spread - 1
    return F.least(F.greatest(strength, F.lit(1.0)), F.lit(10_000.0))


def _log_odds(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(safe / (1 - safe))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    levels: dict[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """id, evidence (probability from the text alone), site_prior, score, kept.

    `levels` name the site hierarchy from the top down, e.g. host, path. `labels` has
    the id and a label of 0 or 1.
    """
    names = list(levels)
    labelled = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = labelled.groupBy(F.col(id_col).alias("id")).agg(
        F.avg(F.col(label_col).cast("double")).alias("label")
    )
    measured = with_features(
        docs.select(
            F.col(id_col).cast("bigint").alias("id"),
            *[c.alias(f"level{i}") for i, c in enumerate(levels.values())],
            F.col(text_col).alias("text"),
        )
    )
    keys = [f"level{i}" for i in range(len(names))]
    measured = stored(measured.join(known, "id", "left"), "features")

    # A bounded sample of labelled rows fits the model.
    place = F.md5(F.col("id").cast("string").cast("binary"))
    sample = (
        measured.filter("label is not null")
        .select("features", "label", place.alias("place"))
        .orderBy("place")
        .limit(fit_rows)
        .toArrow()
    )
    x = np.array(sample.column("features").to_pylist(), float).reshape(-1, N_FEATURES)
    y = np.asarray(sample.column("label"), float)
    model = fit_evidence(x, (y >= 0.5).astype(float))
    base = float(np.clip((y >= 0.5).mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))

    odds = model.log_odds("features")
    rows = measured.select("id", *keys, odds.alias("odds"), "label")
    probability = 1 / (1 + F.exp(-F.col("odds")))
    rows = rows.withColumn("evidence", probability)
    rows = rows.withColumn("good", F.coalesce("label", "evidence")).drop("label")

    sums = [F.sum("good").alias("good"), F.count(F.lit(1)).cast("double").alias("n")]
    total = rows.agg(*sums)
    mean = F.coalesce(total.select(F.col("good") / F.col("n")).scalar(), F.lit(base))
    # One row per path, with the sums and the strength of the prior of every level above.
    table = None
    for depth in range(len(keys)):
        key = keys[: depth + 1]
        groups = stored(rows.groupBy(*key).agg(*sums), f"level-{depth}")
        strength = groups.agg(_strength(mean).alias("k"))
        groups = groups.select(
            *key,
            F.col("good").alias(f"good{depth}"),
            F.col("n").alias(f"n{depth}"),
            F.coalesce(strength.scalar(), F.lit(1.0)).alias(f"k{depth}"),
        )
        table = groups if table is None else _joined(groups, table, keys[:depth])
    table = stored(table.withColumn("mean", mean), "shares")

    # The table's size is known: Spark broadcasts it if it is small, and else joins two
    # scans, whose large keys it splits.
    joined = _joined(rows, table, keys)
    prior = F.col("mean")
    for depth in range(len(keys)):
        others = F.greatest(F.col(f"good{depth}") - F.col("good"), F.lit(0.0))
        k = F.col(f"k{depth}")
        prior = (others + k * prior) / (F.col(f"n{depth}") - 1 + k)
    posterior = F.col("odds") - float(np.log(base / (1 - base))) + _log_odds(prior)
    score = 1 / (1 + F.exp(-posterior))
    result = joined.select(
        F.col("id").alias(id_col), "evidence", prior.alias("site_prior"), score.alias("score")
    )
    return result.withColumn("kept", F.col("score") >= threshold)


def _joined(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with the columns of `table`, which is unique on `keys`; NULL matches NULL."""
    other = table.withColumnsRenamed({c: f"other_{c}" for c in keys})
    condition = F.lit(True)
    for c in keys:
        condition = condition & rows[c].eqNullSafe(other[f"other_{c}"])
    return rows.join(other, condition).drop(*[f"other_{c}" for c in keys])
