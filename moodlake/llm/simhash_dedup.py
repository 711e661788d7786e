"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most ``2 k`` bits exactly when some third value lies within
``k`` bits of both. So every distinct fingerprint emits its ball of radius ``k``, the
variants are shuffled, and the fingerprints that meet at a variant are linked. A variant
group holds at most one fingerprint per member of the ball (65 for ``k = 1``), however many
documents share a fingerprint, so no group is hot and no pairs of a group are expanded.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import connected_components, prepare, settle

SEED = 42
WORDS = 3
RADIUS = 2
BLOCK = 1 << 16


def simhash(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of the word shingles of a text as a signed integer; 0 without words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = (np.cumsum([len(p) + 1 for p in parts]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    width = min(words, len(parts))
    xx = xxhash.xxh64_intdigest
    hashes = np.array([xx(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :])], np.uint64).astype(">u8")
    votes = np.zeros(64, np.int64)
    # A block at a time: unpacked bits take eight times the room of the hashes.
    for at in range(0, len(hashes), BLOCK):
        votes += np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes)).view(">i8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = WORDS, more: dict[str, Column] | None = None
) -> DataFrame:
    """One row ``(doc_id, more..., fp)`` for each row of ``docs``; a null text is an empty one.

    ``more`` names further long columns to carry along.
    """
    names = list(more or {})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fp = np.array([simhash(t, words) for t in frame["t"]], np.int64)
            yield frame[["doc_id", *names]].assign(fp=fp)

    prepare(docs.sparkSession)
    # Ids pass as text so that a null stays a null.
    carried = [c.cast("string").alias(n) for n, c in {"doc_id": F.col(id_col), **(more or {})}.items()]
    thin = docs.select(*carried, F.coalesce(F.col(text), F.lit("")).alias("t"))
    made = thin.mapInPandas(run, "".join(f"{n} string, " for n in ["doc_id", *names]) + "fp long")
    return made.select(*[F.col(n).cast("long").alias(n) for n in ["doc_id", *names]], "fp")


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified links ``(a, b)`` that join all fingerprints within ``radius`` bits.

    At each variant every fingerprint is linked to the smallest one there. All that meet at a
    variant are within ``radius`` of each other, so this keeps every connection.
    """
    if radius < 2 or radius % 2:
        raise ValueError("the radius is twice the radius of the balls: an even number")
    masks = [0]
    for k in range(1, radius // 2 + 1):
        masks += [sum(1 << b for b in c) for c in combinations(range(64), k)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    ball = F.transform(F.array(*[F.lit(m) for m in signed]), lambda m: F.col("fp").bitwiseXOR(m))
    met = distinct.select("fp", F.explode(ball).alias("variant"))
    met = met.withColumn("low", F.min("fp").over(Window.partitionBy("variant")))
    pairs = met.filter("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _members(least: DataFrame, radius: int) -> DataFrame:
    """The rows of distinct fingerprints, each with the component it belongs to."""
    groups = connected_components(links(least.select("fp"), radius), "simhash-links")
    member = least.join(groups, least.fp == groups.node, "left")
    return settle(member.select(*least.columns, F.coalesce("component", "fp").alias("component")), "simhash-members")


def near_duplicates(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", radius: int = RADIUS, words: int = WORDS
) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest id of the documents reachable over links. Texts without
    words have fingerprint 0 and are linked like others. Repeated rows each get their row. A
    row with a null id takes part; its component is null only if no member has an id.
    """
    fps = settle(fingerprints(docs, text, id_col, words), "simhash")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    member = _members(least, radius)
    heads = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = member.join(heads, "component").select(F.col("fp").alias("key"), "component_id")
    named = settle(named, "simhash-named")
    return fps.join(named, fps.fp == named.key).select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", radius: int = RADIUS, words: int = WORDS
) -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: of each component one row stays.

    It is the row with the smallest id, null ids last, and among rows of that id the one whose
    text has the smallest hash; of rows that are equal in both one stays. A row stands for its
    own text, whatever other rows share its id. Only ids, hashes and fingerprints are grouped.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    hashes = {"h1": F.xxhash64(body), "h2": F.xxhash64(F.lit("second"), body)}
    fps = settle(fingerprints(docs, text, id_col, words, hashes), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("gone"), "doc_id", "h1", "h2")).alias("first")
    member = _members(fps.groupBy("fp").agg(first), radius)
    heads = member.groupBy("component").agg(F.min("first").alias("first"))
    # Names that no column of ``docs`` has.
    own = {n: f"_{uuid.uuid4().hex}_{n}" for n in ("doc_id", "h1", "h2")}
    heads = settle(heads.select(*[F.col(f"first.{n}").alias(own[n]) for n in own]), "simhash-heads")
    same = docs[id_col].eqNullSafe(heads[own["doc_id"]]) & (hashes["h1"] == heads[own["h1"]]) & (hashes["h2"] == heads[own["h2"]])
    # The hashes are part of the join's keys; a head met by several equal rows keeps one.
    return docs.join(heads, same, "inner").dropDuplicates(list(own.values())).drop(*own.values())
