"""Language identification: averaged hashed subword embeddings and a linear softmax.

The model is trained by stochastic gradient descent in numpy on a bounded sample; its
probabilities are calibrated by one temperature on a part of the sample it has not seen, and
so is the score below which a prediction counts as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import crc_part, prepare, sampled, settle

PARTS, HELD_OUT = 3, 1
BUCKETS = 1 << 14
DIM = 16
PER_LANGUAGE = 600
UNKNOWN = "und"

_OTHER = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_ASCII_LETTER.search(text) or any(c.isalpha() for c in text))


def subwords(text: str) -> np.ndarray:
    """Buckets of the 2- to 4-byte subwords of a lower-cased text, repeats included.

    Bytes that are not letters become spaces; subwords that span two words are left out, those
    that begin or end with one space mark the ends of words.
    """
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(_OTHER) + b" ", np.uint8)
    blank = raw == 32
    raw = raw[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.uint32)
    inner = raw == 32
    out, code = [], raw
    for width in (2, 3, 4):
        code = code[:-1] * np.uint32(0x01000193) + raw[width - 1 :]
        ok = np.ones(len(code), bool)
        for k in range(1, width - 1):
            ok &= ~inner[k : k + len(code)]
        mixed = code * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        out.append((mixed[ok] * np.uint32(0x85EBCA6B)) >> np.uint32(18))
    return np.concatenate(out)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their shares."""
    counts = np.bincount(subwords(text), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at] / max(1, counts.sum())


@dataclass
class Model:
    """``rows`` holds the class scores of each bucket, scaled by the temperature."""

    langs: list[str]
    rows: np.ndarray
    bias: np.ndarray
    reject: float = 0.0

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        got = subwords(text)
        z = self.bias + (np.bincount(got, minlength=BUCKETS) @ self.rows / len(got) if len(got) else 0.0)
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], langs: list[str], epochs: int = 6, rate: float = 20.0, precision: float = 0.99) -> Model:
    """Train on every document but each fifth, calibrate on those."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    y = np.array([names.index(x) for x in langs])
    draw = np.random.default_rng(7)
    held = np.arange(len(y)) % 5 == 4
    learn = np.flatnonzero(~held)
    emb = draw.normal(0, 0.1, (BUCKETS, DIM))
    out, bias = draw.normal(0, 0.1, (DIM, len(names))), np.zeros(len(names))
    steps, done = epochs * (len(learn) // 32 + 1), 0
    for _ in range(epochs):
        draw.shuffle(learn)
        for at in range(0, len(learn), 32):
            pick = [k for k in learn[at : at + 32] if len(bags[k][0])]
            if not pick:
                continue
            step = rate * (1 - done / steps)
            done += 1
            ids, shares = (np.concatenate([bags[k][j] for k in pick]) for j in (0, 1))
            size = np.array([len(bags[k][0]) for k in pick])
            owner = np.repeat(np.arange(len(pick)), size)
            mean = np.add.reduceat(emb[ids] * shares[:, None], np.cumsum(size) - size)
            error = _softmax(mean @ out + bias)
            error[np.arange(len(pick)), y[pick]] -= 1
            error /= len(pick)
            back = error @ out.T
            out -= 0.1 * step * mean.T @ error
            bias -= 0.01 * step * error.sum(0)
            change = back[owner] * shares[:, None]
            for d in range(DIM):
                emb[:, d] -= step * np.bincount(ids, change[:, d], BUCKETS)
    rows = emb @ out
    test = np.flatnonzero(held)
    if not len(test):
        return Model(names, rows, bias)
    z = np.array([bias + (bags[k][1] @ rows[bags[k][0]] if len(bags[k][0]) else 0.0) for k in test])
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(z * t)[np.arange(len(test)), y[test]] + 1e-12).mean() for t in grid]
    heat = grid[int(np.argmin(loss))]
    p = _softmax(z * heat)
    top, right = p.max(1), p.argmax(1) == y[test]
    order = np.argsort(-top)
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
    reject = float(top[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(names, rows * heat, bias * heat, reject)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on about ``per_language`` documents of each language outside the held-out part.

    They are drawn by a hash of the id. That parameter bounds what reaches the driver: the
    bags of those documents, at most ``BUCKETS`` entries each. Rare languages are kept whole.
    """
    prepare(docs.sparkSession)
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).filter(crc_part("doc_id", PARTS) != HELD_OUT)
    known = known.select("doc_id", F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).withColumnRenamed("lang", "_lang")
    sizes = settle(sizes, "language-sizes")
    ids = known.select("doc_id", "lang").join(sizes, F.col("lang") == F.col("_lang"))
    ids = ids.filter(sampled("doc_id", F.lit(float(per_language)) / F.col("n")))
    ids = settle(ids.select(F.col("doc_id").alias("_id")).distinct(), "language-draw")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bags = [bag(t) for t in frame["text"]]
            yield pd.DataFrame({"key": frame["key"], "lang": frame["lang"], "at": [b[0] for b in bags], "share": [b[1] for b in bags]})

    # At most per_language ids for each language: small enough to broadcast.
    rows = known.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi")
    rows = rows.select(F.xxhash64("doc_id", "text").alias("key"), "lang", "text")
    got = rows.mapInPandas(run, "key long, lang string, at array<int>, share array<float>").toPandas()
    got = got.sort_values(["key", "lang"])
    return fit([(np.asarray(a, np.int64), np.asarray(s, float)) for a, s in zip(got["at"], got["share"])], got["lang"].tolist())


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)``, one row per row of ``docs``.

    ``und`` with score 0 where the text is null or has no letter, or no language was learned.
    ``rejected`` marks scores under the calibrated threshold.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [model.predict(t) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "lang_pred": [m[0] for m in made], "score": [m[1] for m in made]})

    prepare(docs.sparkSession)
    thin = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(text).alias("text"))
    made = thin.mapInPandas(run, "doc_id string, lang_pred string, score double")
    made = made.withColumn("doc_id", F.col("doc_id").cast("long"))
    return made.select(
        "doc_id",
        (crc_part("doc_id", PARTS) == HELD_OUT).alias("held_out"),
        "lang_pred",
        "score",
        ((F.col("lang_pred") == UNKNOWN) | (F.col("score") < model.reject)).alias("rejected"),
    )
