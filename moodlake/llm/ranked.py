"""Ranked lexical search by MaxScore with bounds of term pairs.

Texts are cut into terms in one pass, and the postings of the query terms are kept in shards of
documents. The statistics of all documents (N, L, df) come from the same pass. Then every shard
is searched on its own, for a block of queries at a time:

* A query's terms are joined into pairs. For a pair the shard makes the list of documents with
  both terms, with their joint impacts and the largest of them. No document gets more from the
  pair than that or than the larger of what each term gives alone, which is less than the sum of
  both maxima wherever the terms seldom meet at their best.
* With these bounds the query's pairs are sorted; the low ones whose bounds add up to less than
  the 20th score so far cannot bring a document in. Only documents of the other pairs are
  looked at, and they leave as soon as the bounds left cannot lift them to that score.
* The 20th score is carried from shard to shard of a task; it starts from documents of the best
  intersection lists.

Each task returns its best 20 of a query, which are then ranked over all tasks. All scores are
exact 64-bit integers, and nothing but the skipping depends on the bounds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import prepare, settle

TOP = 20
SHARD_DOCS = 1 << 15
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 4 << 20

# Letters, digits and all bytes of other scripts are kept, capitals lower-cased.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def _squeeze(values: np.ndarray) -> bytes:
    planes = values.astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _spread(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").reshape(-1)


class _Building:
    """The postings of a shard as documents come."""

    def __init__(self):
        self.docs: list[tuple[bool, int, int, list[int]]] = []
        self.size = 0

    def add(self, doc: str | None, text: str, known: dict[bytes, int]) -> None:
        found = terms(text)
        self.size += len(text)
        if found:
            self.docs.append((doc is None, int(doc or 0), len(found), [known[t] for t in found if t in known]))

    def rows(self, shard: int) -> pd.DataFrame:
        # In the order of ids, so that a place in the shard also settles ties.
        self.docs.sort(key=lambda d: d[:3])
        many = np.array([len(d[3]) for d in self.docs], np.int64)
        owner = np.repeat(np.arange(len(self.docs)), many)
        term = np.fromiter((t for d in self.docs for t in d[3]), np.int64, int(many.sum()))
        # One posting for each term of a document, by term and then by document.
        key, tf = np.unique(term << 32 | owner, return_counts=True)
        term, df = np.unique(key >> 32, return_counts=True)
        lens = np.array([d[2] for d in self.docs], np.int64)
        row = {
            "shard": shard, "term": None, "df": len(self.docs), "total": int(lens.sum()),
            "ids": _squeeze(np.array([d[1] for d in self.docs], np.int64)),
            "missing": np.packbits(np.array([d[0] for d in self.docs], bool)).tobytes(),
            "lens": _squeeze(lens), "docs": _squeeze(key & 0xFFFFFFFF), "tfs": _squeeze(tf),
            "terms": _squeeze(term), "dfs": _squeeze(df),
        }
        return pd.DataFrame([row, *({"shard": shard, "term": t, "df": n} for t, n in zip(term.tolist(), df.tolist()))], columns=list(row))


_SHARD = "shard long, term long, df long, total long, ids binary, missing binary, lens binary, docs binary, tfs binary, terms binary, dfs binary"


def _index(docs: DataFrame, text: str, id_col: str, known, shard_docs: int, shard_bytes: int) -> DataFrame:
    """Shards of postings, with a row for each term of a shard that counts its documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard, now = TaskContext.get().partitionId() << 32, _Building()
        for frame in frames:
            for doc, t in zip(frame["doc_id"], frame["t"]):
                now.add(doc, t, known.value)
                if len(now.docs) >= shard_docs or now.size >= shard_bytes:
                    if now.docs:
                        yield now.rows(shard)
                    shard, now = shard + 1, _Building()
        if now.docs:
            yield now.rows(shard)

    thin = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text).alias("t")).filter("t is not null")
    return settle(thin.mapInPandas(run, _SHARD), "ranked-shards")


class Queries:
    """A block of queries: distinct terms of each with their repeats, and weights of all terms."""

    def __init__(self, texts: list[str | None], numbers: dict[bytes, int], found: int, total: int, df: dict[int, int]):
        self.found, self.total = found, total
        self.weight = np.array(
            [math.floor(1000 * math.log((2 * found + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(numbers))], np.int64
        )
        self.asked = [Counter(numbers[t] for t in terms(text)) for text in texts]


class Shard:
    """Postings with impacts, and intersection lists of the pairs that were asked for."""

    def __init__(self, row, queries: Queries):
        self.ids = _spread(row.ids)
        self.missing = np.unpackbits(np.frombuffer(row.missing, np.uint8), count=len(self.ids)).astype(bool)
        m = 100 - 25 + (25 * _spread(row.lens) * queries.found) // queries.total
        docs, tf = _spread(row.docs), _spread(row.tfs)
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[docs])
        ends = np.cumsum(_spread(row.dfs))
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for t, s, e in zip(_spread(row.terms).tolist(), [0, *ends.tolist()], ends.tolist()):
            if queries.weight[t] > 0:
                self.lists[t] = docs[s:e], impact[s:e] * queries.weight[t]
        self.most = {t: int(i.max()) for t, (_, i) in self.lists.items()}
        self.pairs: dict[tuple, tuple[int, np.ndarray]] = {}
        self.space = np.zeros(len(self.ids), np.int64)

    def lookup(self, t: int, docs: np.ndarray) -> np.ndarray:
        """Impacts of a term in some documents, 0 where it does not occur."""
        own, impact = self.lists[t]
        at = np.searchsorted(own, docs)
        at[at == len(own)] = 0
        return np.where(own[at] == docs, impact[at], 0)

    def pair(self, a: int, x: int, b: int, y: int) -> tuple[int, np.ndarray]:
        """Joint maximum impact of two terms, taken ``x`` and ``y`` times, and the documents that
        have both, the best first few."""
        key = (a, x, b, y)
        if key not in self.pairs:
            if len(self.lists[a][0]) > len(self.lists[b][0]):
                a, x, b, y = b, y, a, x
            docs, impact = self.lists[a]
            other = self.lookup(b, docs)
            both = other > 0
            joint = impact[both] * x + other[both] * y
            best = np.argpartition(-joint, TOP)[:TOP] if len(joint) > TOP else np.arange(len(joint))
            self.pairs[key] = int(joint.max(initial=0)), docs[both][best]
        return self.pairs[key]

    def search(self, asked: Counter, floor: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents that may be among the best ``top``; none that
        scores ``floor`` or more and belongs there is left out."""
        use = sorted(((self.most[t] * n, t, n) for t, n in asked.items() if t in self.lists), reverse=True)
        units = []
        for k in range(0, len(use), 2):
            both = use[k : k + 2]
            if len(both) == 1:
                docs, impact = self.lists[both[0][1]]
                units.append((both[0][0], both, docs[:TOP]))
            else:
                joint, docs = self.pair(both[0][1], both[0][2], both[1][1], both[1][2])
                units.append((max(joint, both[0][0], both[1][0]), both, docs))
        units.sort(key=lambda u: u[0])
        bounds = np.cumsum([0, *(u[0] for u in units)])
        if not units or bounds[-1] < floor:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # A first floor: whole scores of documents from the best lists.
        seeds, k = np.zeros(0, np.int64), len(units)
        while k and len(seeds) < 2 * top:
            k -= 1
            seeds = np.union1d(seeds, units[k][2])
        if len(seeds) >= top:
            scores = sum((self.lookup(t, seeds) * n for _, t, n in use), np.zeros(len(seeds), np.int64))
            floor = max(floor, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
        floor = max(floor, 1)
        # Units below ``first`` cannot reach the floor together.
        first = int(np.searchsorted(bounds, floor, side="left")) - 1
        for _, both, _ in units[first:]:
            for _, t, n in both:
                docs, impact = self.lists[t]
                self.space[docs] += impact * n
        found = np.flatnonzero(self.space)
        scores = self.space[found]
        self.space[found] = 0
        for k in range(first, 0, -1):
            stay = scores + bounds[k] >= floor
            found, scores = found[stay], scores[stay]
            for _, t, n in units[k - 1][1]:
                scores = scores + self.lookup(t, found) * n
        stay = scores >= floor
        found, scores = found[stay], scores[stay]
        order = np.lexsort((found, -scores))[:top]
        return found[order], scores[order]


def _searcher(queries, block: int, top: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = queries.value.asked
        best: list[list[tuple[int, bool, int]]] = [[] for _ in asked]
        for frame in frames:
            for row in frame.itertuples(index=False):
                shard = Shard(row, queries.value)
                for q, want in enumerate(asked):
                    floor = -best[q][-1][0] if len(best[q]) == top else 1
                    found, scores = shard.search(want, floor, top)
                    if len(found):
                        new = zip((-scores).tolist(), shard.missing[found].tolist(), shard.ids[found].tolist())
                        best[q] = sorted([*best[q], *new])[:top]
        rows = [(block, q, -s, None if gone else i) for q, b in enumerate(best) for s, gone, i in b]
        out = pd.DataFrame(rows, columns=["block", "q", "score", "doc_id"])
        yield out.astype({"doc_id": "Int64"})

    return run


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    shard_docs: int = SHARD_DOCS,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the best ``top`` documents of each query row.

    Ties go to the smaller id, a null id last. Null and empty texts have no terms: such
    documents are not counted, such queries and those that match nothing have no rows. A
    repeated query row is answered again, a repeated document is ranked again. Queries are
    taken in blocks of bounded size, each in two passes; a block and its terms are broadcast.
    """
    spark = prepare(docs.sparkSession)
    asked = queries.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("t")).filter("t is not null")
    size = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item", "t"), F.lit(blocks)))
    out = None
    for block in range(blocks):
        rows = sorted(((r.item, r.t) for r in asked.filter(F.col("block") == block).collect()), key=str)
        numbers: dict[bytes, int] = {}
        for _, t in rows:
            for word in terms(t):
                numbers.setdefault(word, len(numbers))
        index = _index(docs, text, id_col, spark.sparkContext.broadcast(numbers), shard_docs, shard_bytes)
        found, total = index.filter("ids is not null").agg(F.sum("df"), F.sum("total")).first()
        df = {r.term: r.n for r in index.filter("term is not null").groupBy("term").agg(F.sum("df").alias("n")).collect()}
        use = spark.sparkContext.broadcast(Queries([t for _, t in rows], numbers, found or 0, total or 0, df))
        shards = index.filter("ids is not null").drop("shard", "term", "df", "total")
        best = shards.mapInPandas(_searcher(use, block, top), "block long, q long, score long, doc_id long")
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(rows)], "q long, item string")
        part = best.join(F.broadcast(names), "q")
        out = part if out is None else out.unionAll(part)
    order = Window.partitionBy("block", "q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(F.col("item").cast("long").alias("item_id"), "rank", "doc_id", "score")
