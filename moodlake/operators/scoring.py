"""Sentiment scoring: a word-list scorer in the JVM and an adapter for any model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.functions.text import find_words
from moodlake.schemas import SCORE_FIELDS

# Texts in, (label, score) per text out. The factory runs once per task.
Scorer = Callable[[list[str]], Sequence[tuple[str, float]]]


def score_words(df: DataFrame, text: str, positive: Sequence[str], negative: Sequence[str]) -> DataFrame:
    """Adds label and score from counts of listed words.

    The label is the side with more words, 'neutral' on a tie; the score is that side's
    share with one added to both counts. Null text gives null label and score.
    """
    def hits(words: Sequence[str]):
        return F.array_size(F.filter("_hits", lambda w: w.isin(list(words)) if words else F.lit(False)))

    found = df.withColumn("_hits", find_words(text, [*positive, *negative]))
    counted = found.withColumn("_pos", hits(positive)).withColumn("_neg", hits(negative))
    label = (
        F.when(F.col("_neg") > F.col("_pos"), "negative")
        .when(F.col("_pos") > F.col("_neg"), "positive")
        .when(F.col("_pos") == F.col("_neg"), "neutral")
    )
    top = F.greatest("_pos", "_neg")
    score = F.when(label.isNotNull(), (top + 1) / (F.col("_pos") + F.col("_neg") + 2))
    return counted.withColumn("label", label).withColumn("score", score).drop("_hits", "_pos", "_neg")


def score_model(
    df: DataFrame, text: str, make_scorer: Callable[[], Scorer], keep: Sequence[str] = (), batch: int = 32,
) -> DataFrame:
    """Columns ``keep`` plus label, score and error from a model.

    The model is loaded once per task and fed ``batch`` texts at a time. When a batch
    raises, its texts are tried one by one, so one bad text costs one error row.
    Whole texts go to the model, which may split them itself. Null or empty text is not
    sent to the model: its label, score and error are null.
    """
    keep = list(keep)
    schema = T.StructType([*[df.schema[c] for c in keep], *SCORE_FIELDS])

    def one_by_one(scorer: Scorer, texts: list[str]) -> list[tuple]:
        out = []
        for t in texts:
            try:
                label, score = scorer([t])[0]
                out.append((label, float(score), None))
            except Exception as exc:
                out.append((None, None, f"{type(exc).__name__}: {exc}"))
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for frame in frames:
            results: list[tuple] = [(None, None, None)] * len(frame)
            given = frame["_text"].tolist()
            todo = [i for i, t in enumerate(given) if t]
            for at in range(0, len(todo), batch):
                part = todo[at : at + batch]
                texts = [given[i] for i in part]
                try:
                    scored = [(label, float(score), None) for label, score in scorer(texts)]
                    if len(scored) != len(texts):
                        raise ValueError(f"{len(scored)} scores for {len(texts)} texts")
                except Exception:
                    scored = one_by_one(scorer, texts)
                for i, result in zip(part, scored):
                    results[i] = result
            out = frame[keep].copy()
            out["label"], out["score"], out["error"] = (list(c) for c in zip(*results)) if results else ([], [], [])
            yield out

    return df.select(*keep, F.col(text).alias("_text")).mapInPandas(run, schema)
