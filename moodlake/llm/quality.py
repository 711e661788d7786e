"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm.common import crc_part, prepare, sampled, settle

MAX_TRAIN = 16_000
PARTS, HELD_OUT = 4, 2
ACCEPT = 0.7

FEATURES = [
    "log_bytes", "log_words", "word_length", "distinct_words", "log_lines", "distinct_lines", "line_words",
    "upper", "digit", "space", "high", "stop", "comma", "bang", "question", "bar", "colon", "quote", "slash",
    "bracket", "symbol", "symbol_words", "entropy", "longest_word",
]

_UPPER = np.arange(ord("A"), ord("Z") + 1)
_LOWER = np.arange(ord("a"), ord("z") + 1)
_DIGIT = np.arange(ord("0"), ord("9") + 1)
_SYMBOL = np.frombuffer(b"#$%&*+=<>@^_~`\\", np.uint8)


def statistics(text: str | None) -> list[float]:
    """The features of one whole text; an empty or null text has zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, w = len(raw), len(words)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(1, int(counts[_UPPER].sum() + counts[_LOWER].sum()))
    share = counts[counts > 0] / n
    ends = sum(x[-1] in b"#$%&*!|" for x in words)
    at = lambda chars: float(sum(counts[c] for c in chars)) / w
    return [
        float(np.log1p(n)), float(np.log1p(w)), n / w, len(set(words)) / w, float(np.log1p(len(lines))),
        len(set(lines)) / len(lines), w / len(lines), float(counts[_UPPER].sum()) / letters,
        float(counts[_DIGIT].sum()) / n, float(counts[32]) / n, float(counts[128:].sum()) / n, at(b"."), at(b","),
        at(b"!"), at(b"?"), at(b"|"), at(b":;"), at(b"\"'"), at(b"/"), at(b"()[]{}"),
        float(counts[_SYMBOL].sum()) / w, ends / w, float(-(share * np.log2(share)).sum()),
        float(np.log1p(max(map(len, words)))),
    ]


def features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the array ``x`` of statistics."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[keep].assign(x=[statistics(t) for t in frame[text]])

    return docs.select(*keep, text).mapInPandas(run, schema)


@dataclass
class Trees:
    """Complete binary trees, flattened: ``split`` and ``cut`` by node, ``leaf`` by leaf."""

    base: float
    split: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; all trees walk down together, level by level."""
        if not len(self.leaf):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        trees = np.arange(len(self.leaf))
        node = np.zeros((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        inner = self.split.shape[1]
        while node[0, 0] < inner if len(x) else False:
            right = x[rows, self.split[trees, node]] > self.cut[trees, node]
            node = 2 * node + 1 + right
        total = self.base + self.leaf[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def boost(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0
) -> Trees:
    """Fit by logistic loss; every level takes one histogram of gradients per node and feature."""
    inner, leaves = 2**depth - 1, 2**depth
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    empty = Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if len(y) < 2 or y.min() == y.max():
        return empty
    rows, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(width)]
    code = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    usable = np.array([[b < len(e) for b in range(bins)] for e in edges])
    logit = np.full(rows, base)
    split, cut, leaf = (np.zeros((trees, k)) for k in (inner, inner, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-logit))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(rows, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            place = node - first
            flat = ((place[:, None] * width + np.arange(width)) * bins + code).ravel()
            size = many * width * bins
            g = np.bincount(flat, np.repeat(grad, width), size).reshape(many, width, bins).cumsum(2)
            h = np.bincount(flat, np.repeat(hess, width), size).reshape(many, width, bins).cumsum(2)
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
            gain = np.where(usable & (h > 2 * ridge) & (ht - h > 2 * ridge), gain, -1.0).reshape(many, -1)
            best = gain.argmax(1)
            f, b = best // bins, best % bins
            none = gain[np.arange(many), best] <= 1e-6
            split[t, first : first + many] = np.where(none, 0, f)
            cut[t, first : first + many] = [np.inf if no else edges[i][j] for no, i, j in zip(none, f, b)]
            right = x[np.arange(rows), split[t, node].astype(np.int64)] > cut[t, node]
            node = 2 * node + 1 + right
        place = node - inner
        g, h = np.bincount(place, grad, leaves), np.bincount(place, hess, leaves)
        leaf[t] = rate * g / (h + ridge)
        logit += leaf[t, place]
    return Trees(base, split.astype(np.int64), cut, leaf)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN) -> Trees:
    """Fit on labelled documents outside the held-out part.

    At most about ``max_train`` labelled ids are drawn by a hash of the id; that bound is what
    lets them be broadcast and fitted on the driver. A document with several labels takes the
    mean. Without any label the score is 0.5 everywhere.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.filter(crc_part("doc_id", PARTS) != HELD_OUT)
    total = known.count()
    drawn = known.filter(sampled("doc_id", max_train / max(total, max_train)))
    drawn = drawn.groupBy("doc_id").agg(F.avg(label).alias("y")).withColumnRenamed("doc_id", "_id")
    drawn = settle(drawn, "quality-labels")
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
    got = features(rows.select("doc_id", "y", "text"), ["doc_id", "y"]).toPandas().sort_values(["doc_id", "y"])
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    return boost(x, (got["y"].to_numpy(float) >= 0.5).astype(float))


def score(docs: DataFrame, model: Trees) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array([statistics(t) for t in frame["text"]], float).reshape(-1, len(FEATURES))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": model.score(x)})

    prepare(docs.sparkSession)
    thin = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    made = thin.mapInPandas(run, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))
    return made.select(
        "doc_id",
        (crc_part("doc_id", PARTS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def accept(docs: DataFrame, model: Trees) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``ACCEPT``."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            x = np.array([statistics(t) for t in texts], float).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= ACCEPT))

    prepare(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
