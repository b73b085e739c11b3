"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL.

Words are runs of letters and digits, and runs of other visible characters. Features are
single words and pairs of neighbours, hashed to a fixed number of slots; a word followed by itself
counts as one and the same pair, whatever the word, as repetition is a mark of poor text in any
vocabulary. A document's vector is the counts over the root of their number. Scoring is a
sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.language import trained_on
from haulmark.llm.tables import map_texts
from haulmark.llm.text import (
    codes,
    groups,
    mix64,
    owners,
    space_table,
    span_hashes,
    sums,
    word_table,
)

THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityConfig:
    slots: int = 1 << 18
    sample_rows: int = 2_000  # labelled documents of each class that the model is fitted on
    shards: int = 4  # learners whose weights are averaged; each sees all of the rarer class
    epochs: int = 3
    alpha: float = 0.5  # learning rate of follow-the-regularised-leader
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.5


def features(texts: list[str], slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot and text of each n-gram, in order of the texts, and n-grams per text.

    Case is kept: it is a mark of quality.
    """
    points, text_starts = codes(texts)
    visible = ~space_table()[points]
    kind = np.where(visible, np.where(word_table()[points], 1, 2), 0)
    before = np.concatenate([[0], kind[:-1]])
    after = np.concatenate([kind[1:], [0]])
    starts = np.flatnonzero(visible & (kind != before))
    stops = np.flatnonzero(visible & (kind != after)) + 1
    words, owner = span_hashes(points, starts, stops), owners(starts, text_starts)
    paired = owner[1:] == owner[:-1]
    pairs = np.where(
        words[:-1] == words[1:], np.uint64(1), mix64(words[:-1] * np.uint64(3) + words[1:])
    )[paired]
    grams = np.concatenate([words, pairs])
    of = np.concatenate([owner, owner[:-1][paired]])
    order = np.argsort(of, kind="stable")
    slot = (grams[order] & np.uint64(slots - 1)).astype(np.int64)
    return slot, of[order], np.bincount(of, minlength=len(texts))


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray  # slots
    bias: float
    config: QualityConfig


def _logistic(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def fit(texts: list[str], labels: list[int], config: QualityConfig) -> tuple[np.ndarray, float]:
    """Weights and bias after ``epochs`` passes of FTRL-proximal, document by document.

    Both classes weigh the same in all, however rare one of them is.
    """
    z, n = np.zeros(config.slots + 1), np.zeros(config.slots + 1)
    sizes = np.maximum(np.bincount(labels, minlength=2), 1)
    class_weight = len(labels) / 2 / sizes
    rows = []
    for _, group in groups(texts):
        slot, owner, _ = features(group, config.slots)
        bounds = np.searchsorted(owner, np.arange(len(group) + 1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            at, count = np.unique(slot[a:b], return_counts=True)
            # The last slot is the bias, which is not regularised towards 0.
            value = np.append(count / np.sqrt(max(1, b - a)), 1.0)
            rows.append((np.append(at, config.slots).astype(np.int32), value.astype(np.float32)))

    def weights(at: np.ndarray) -> np.ndarray:
        strength = np.where(at == config.slots, 0.0, config.l1)
        rate = (config.beta + np.sqrt(n[at])) / config.alpha + config.l2
        return np.where(np.abs(z[at]) <= strength, 0.0, -(z[at] - np.sign(z[at]) * strength) / rate)

    for _ in range(config.epochs):
        for (at, value), label in zip(rows, labels, strict=True):
            w = weights(at)
            gradient = class_weight[label] * (_logistic(float(w @ value)) - label) * value
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / config.alpha
            z[at] += gradient - step * w
            n[at] += gradient**2
    all_weights = weights(np.arange(config.slots + 1))
    return all_weights[:-1], float(all_weights[-1])


def train(
    docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()
) -> QualityModel:
    """Average of the learners, each fitted to its share of the labelled sample.

    Rows with a label, of documents not held out; at most ``sample_rows`` of each class, by
    a hash of their id. An id with several labels has their mean, rounded; one with several
    rows stands with the text of the smallest hash, so that copies of an id are one row before
    anything is gathered. Null texts count as empty. Without labels, or with none but held-out
    ones, the model scores 0.5. The rarer class goes to every learner, as marks that few documents bear would be thinned out by
    averaging; the other is dealt out. A learner's non-zero weights come back as rows.
    """
    once = (
        labels.filter(F.col("quality").isNotNull() & trained_on(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("_label"))
    )
    drawn = F.xxhash64(F.lit("quality-1"), "doc_id")
    sample = None
    for label in (0, 1):
        own = once.filter(F.col("_label") == label)
        own = own.orderBy(drawn, "doc_id").limit(config.sample_rows)
        sample = own if sample is None else sample.unionByName(own)
    # Bounded by twice sample_rows narrow rows, whatever the tables hold.
    met = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    one = F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text")
    chosen = met.groupBy("doc_id", "_label").agg(one)
    counts = {row["_label"]: row["count"] for row in sample.groupBy("_label").count().collect()}
    rarer = min((0, 1), key=lambda label: counts.get(label, 0))
    dealt = F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(config.shards)).cast("int")
    every = F.sequence(F.lit(0), F.lit(config.shards - 1))
    shard = F.explode(F.when(F.col("_label") == rarer, every).otherwise(F.array(dealt)))

    def learn(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [part for part in parts if len(part)]
        if not parts:
            return
        rows = pd.concat(parts).sort_values(["order", "doc_id"], kind="stable")
        weights, bias = fit(rows["text"].tolist(), rows["_label"].tolist(), config)
        at = np.flatnonzero(weights)
        yield pd.DataFrame({"slot": np.append(at, -1), "weight": np.append(weights[at], bias)})

    # A task for each learner, by number: its rows are a bounded sample.
    learned = (
        chosen.select("doc_id", "text", "_label", drawn.alias("order"), shard.alias("shard"))
        .repartitionById(config.shards, F.col("shard"))
        .mapInPandas(learn, "slot int, weight double")
    )
    table = learned.toPandas()
    learners = max(1, int((table["slot"] == -1).sum()))
    table = table.sort_values(["slot", "weight"])
    total = table.groupby("slot")["weight"].sum() / learners
    weights = np.zeros(config.slots)
    at = total.index.to_numpy()
    weights[at[at >= 0]] = total.to_numpy()[at >= 0]
    return QualityModel(weights.astype(np.float32), float(total.get(-1, 0.0)), config)


def scores(texts: list[str], model: QualityModel) -> np.ndarray:
    slot, owner, n = features(texts, model.config.slots)
    dot = sums(model.weights[slot].astype(np.float64), owner, len(texts))
    return _logistic(dot / np.sqrt(np.maximum(n, 1)) + model.bias)


def score(docs: DataFrame, model: QualityModel, keep: list[str]) -> DataFrame:
    """``keep`` columns, score (0 to 1, higher: better) and predicted of every row.

    Null and empty texts have no features and score the bias alone. A model without labels
    scores 0.5. Only ``text`` is looked at.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def rate(texts: list[str | None]) -> Iterator[tuple[int, int, list[pa.Array]]]:
        for start, group in groups(texts):
            found = scores(group, shipped.value)
            yield start, len(group), [
                pa.array(found, pa.float64()),
                pa.array((found >= THRESHOLD).astype(np.int32)),
            ]

    return map_texts(docs, keep, {"score": "double", "predicted": "int"}, rate)
