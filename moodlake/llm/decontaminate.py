"""Benchmark decontamination with SimHash over item-sized windows.

Words are runs of letters and digits, lower-cased; shingles are five words. Windows of a
document have as many shingles as a benchmark item and start at every place. Running sums of the
weights of an item's shingles bound the similarity of each window with it from above; only
windows whose bound is below the threshold, or not above the best already found, are left out.
Each other window's 128-bit SimHash is looked up in a multi-index: of 16
blocks at least one differs in no more than two bits for every fingerprint within the radius,
and items are filed under all such block values. Candidates are verified by their exact
weighted-shingle similarity.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import prepare, settle

WORDS = 5
SIMILARITY = 0.8
RADIUS = 47
BLOCKS = 16
BLOCK_ITEMS = 50_000
BLOCK_BYTES = 8 << 20
#: Window starts and (shingle, item) pairs looked at together in a worker; results do not depend on them.
STARTS = 1 << 14
PAIRS = 1 << 20

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# Letters, digits and all bytes of other scripts are kept, capitals lower-cased.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)
_powers = [np.ones(1, _U), np.ones(1, _U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, step in enumerate((_STEP, _BACK)):
            _powers[k] = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, step)]), dtype=_U)
    return _powers[0][:n], _powers[1][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word of a whole text."""
    raw = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass").translate(_WORD_BYTES), np.uint8)
    inside = np.concatenate([[False], raw != 32, [False]])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turn[::2], turn[1::2]
    if not len(starts):
        return np.zeros(0, _U)
    up, down = _power(len(raw))
    sums = np.concatenate([[_U(0)], np.cumsum(raw.astype(_U) * up, dtype=_U)])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, _U)
    h = np.zeros(n, _U)
    for k in range(width):
        h = h * _U(0xD6E8FEB86659FD93) + words[k : k + n]
    return _mix(h)


class Index:
    """Items of the benchmark: their shingles, weights, and the blocks of their fingerprints.

    All of it is arrays: some 40 bytes a shingle and 512 bytes an item for the blocks. Of a part
    of a benchmark, ``total`` and ``counts`` are those of all of it: how many items have words,
    and in how many items each shingle occurs (hashes and numbers).
    """

    def __init__(
        self, items: list[tuple[int | None, str | None]], total: int | None = None, counts: tuple[np.ndarray, np.ndarray] | None = None
    ):
        self.items: list[tuple[int | None, int, np.ndarray]] = []
        for name, text in items:
            words = word_hashes(text)
            if len(words):
                width = min(WORDS, len(words))
                self.items.append((name, width, shingles(words, width)))
        self.widths = sorted({w for _, w, _ in self.items})
        self.width = np.array([w for _, w, _ in self.items], np.int64)
        sizes = np.array([len(s) for _, _, s in self.items], np.int64)
        flat = np.concatenate([np.zeros(0, _U), *(s for _, _, s in self.items)])
        self.keys, key = np.unique(flat, return_inverse=True)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        pairs = np.unique(np.stack([key, owner], 1), axis=0)
        if counts is None:
            total, counts = len(sizes), (self.keys, np.bincount(pairs[:, 0], minlength=len(self.keys)))
        order = np.argsort(counts[0])
        seen = counts[1][order][np.searchsorted(counts[0][order], self.keys)]
        self.unseen = float(np.log1p(total))
        self.weight = np.log1p(total / seen)
        slots = 1 << max(20, len(self.keys).bit_length() + 4)
        self.slot = _U(slots - 1)
        self.filter = np.zeros(slots, bool)
        self.filter[self.keys & self.slot] = True
        # The items that own each key.
        self.sizes = sizes
        self.owners = pairs[:, 1]
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(self.keys) + 1))
        self.own = [np.unique(k) for k in np.split(key, np.cumsum(sizes)[:-1])] if len(sizes) else []
        self.totals = np.array([float(self.weights(s).sum()) for _, _, s in self.items])
        self.prints = np.array([self.fingerprint(s, self.weights(s)) for _, _, s in self.items], np.uint8).reshape(-1, BLOCKS)
        # For each block and value, a bit map of the items filed there.
        masks = [sum(1 << b for b in c) for k in range(RADIUS // BLOCKS + 1) for c in combinations(range(8), k)]
        filed = self.prints[:, :, None] ^ np.array(masks, np.uint8)
        self.blocks = np.zeros((BLOCKS, 256, -(-len(sizes) // 8)), np.uint8)
        for b in range(BLOCKS):
            on = np.zeros((256, len(sizes)), bool)
            on[filed[:, b], np.arange(len(sizes))[:, None]] = True
            self.blocks[b] = np.packbits(on, axis=1)

    def weights(self, s: np.ndarray) -> np.ndarray:
        at, known = self.find(s)
        return np.where(known, self.weight[at], self.unseen) if len(self.keys) else np.full(len(s), self.unseen)

    def find(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each shingle among the keys, and whether it is one."""
        if not len(self.keys):
            return np.zeros(len(s), np.int64), np.zeros(len(s), bool)
        at = np.minimum(np.searchsorted(self.keys, s), len(self.keys) - 1)
        return at, self.keys[at] == s

    @staticmethod
    def fingerprint(s: np.ndarray, w: np.ndarray) -> np.ndarray:
        """128 bits as 16 bytes: the sign of the weighted votes of the shingles' hashes."""
        wide = np.stack([s, _mix(s + _STEP)], 1).view(np.uint8)
        votes = (np.unpackbits(wide, axis=1) * 2.0 - 1) * w[:, None]
        return np.packbits(votes.sum(0) > 0)

    def near(self, print_: np.ndarray) -> list[int]:
        """All items whose fingerprint lies within the radius."""
        filed = np.bitwise_or.reduce(self.blocks[np.arange(BLOCKS), print_], axis=0)
        found = np.flatnonzero(np.unpackbits(filed, count=len(self.items)))
        bits = np.bitwise_count(self.prints[found] ^ print_).sum(axis=1, dtype=np.int64)
        return found[bits <= RADIUS].tolist()

    def similarity(self, i: int, s: np.ndarray, w: np.ndarray) -> float:
        """Weight of the common shingles, repeats counted, over the larger total weight."""
        mine, his = Counter(self.items[i][2].tolist()), Counter(s.tolist())
        weight = dict(zip(s.tolist(), w.tolist()))
        common = sum(min(n, his[h]) * weight[h] for h, n in mine.items() if h in his)
        return common / max(self.totals[i], float(w.sum()))

    def likely(self, at: np.ndarray, width: int) -> np.ndarray:
        """Items of a width of whose weight the given keys, repeats counted, make up enough."""
        mass = np.zeros(len(self.items))
        many = self.first[at + 1] - self.first[at]
        ends = np.cumsum(many)
        begin = 0
        while begin < len(at):
            past = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, past + PAIRS, side="right")))
            some = many[begin:end]
            row = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some - self.first[at[begin:end]], some)
            mass += np.bincount(self.owners[row], np.repeat(self.weight[at[begin:end]], some), len(mass))
            begin = end
        return np.flatnonzero((mass >= SIMILARITY * self.totals - 1e-6) & (self.width == width))

    def _scan(self, s: np.ndarray, starts: int, width: int, best: dict[int, float]) -> None:
        """Puts into ``best`` the items found in windows that begin at the first ``starts`` shingles."""
        hit = np.flatnonzero(self.filter[s & self.slot])
        at, known = self.find(s[hit])
        hit, at = hit[known], at[known]
        if not len(hit):
            return
        w = self.weights(s)
        run = np.concatenate([[0.0], np.cumsum(w)])
        start, mine = np.arange(starts), np.zeros(len(self.keys), bool)
        near: dict[tuple[int, int], set[int]] = {}
        for i in self.likely(at, width).tolist():
            mine[self.own[i]] = True
            held = np.zeros(len(s))
            own = mine[at]
            held[hit[own]] = self.weight[at[own]]
            mine[self.own[i]] = False
            held = np.concatenate([[0.0], np.cumsum(held)])
            stop = np.minimum(start + self.sizes[i], len(s))
            bound = (held[stop] - held[start]) / np.maximum(self.totals[i], run[stop] - run[start])
            good = np.flatnonzero(bound >= SIMILARITY - 1e-6)
            for p in good[np.argsort(-bound[good], kind="stable")].tolist():
                if bound[p] <= best.get(i, 0) + 1e-9:
                    break
                part, weights, place = s[p : stop[p]], w[p : stop[p]], (p, int(stop[p]))
                if place not in near:
                    near[place] = set(self.near(self.fingerprint(part, weights)))
                if i in near[place]:
                    value = self.similarity(i, part, weights)
                    if value >= SIMILARITY - 1e-9:
                        best[i] = max(best.get(i, 0), value)

    def search(self, text: str | None) -> list[tuple[int | None, float]]:
        """Items contained in a whole text, each with its best similarity."""
        words = word_hashes(text)
        best: dict[int, float] = {}
        for width in self.widths:
            s = shingles(words, width)
            longest = int(self.sizes[self.width == width].max())
            for begin in range(0, len(s), STARTS):
                # A part goes on as far as the windows that begin in it.
                part = s[begin : begin + STARTS + longest]
                self._scan(part, min(STARTS, len(s) - begin), width, best)
        return [(self.items[i][0], v) for i, v in sorted(best.items())]


def _item_shingles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each distinct shingle of an item with words, and one null for the item itself."""
    for frame in frames:
        for k, text in zip(frame["k"], frame["t"]):
            words = word_hashes(text)
            if len(words):
                own = np.unique(shingles(words, min(WORDS, len(words)))).view(np.int64)
                yield pd.DataFrame({"k": k, "h": pd.array([None, *own.tolist()], "Int64")})


def _indexes(docs: DataFrame, benchmark: DataFrame, item: str, item_text: str) -> Iterator[tuple[int, Broadcast]]:
    """Broadcast indexes of bounded size, made one after the other, and how many are to come.

    A block has about ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` of their texts at most. Weights
    are those of the whole benchmark, whatever the blocks.
    """
    spark = prepare(docs.sparkSession)
    items = benchmark.select(F.col(item).alias("i"), F.col(item_text).alias("t")).filter("t is not null")
    many, size = items.agg(F.count("*"), F.sum(F.octet_length("t"))).first()
    blocks = max(1, -(-many // BLOCK_ITEMS), -(-(size or 0) // BLOCK_BYTES))
    items = items.withColumn("k", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    counts = items.select("k", "t").mapInPandas(_item_shingles, "k long, h long").groupBy("h")
    counts = settle(counts.agg(F.count("*").alias("n"), F.collect_set("k").alias("ks")), "decontaminate-shingles")
    total = counts.filter("h is null").first()
    for k in range(blocks):
        rows = sorted(((r.i, r.t) for r in items.filter(F.col("k") == k).collect()), key=str)
        own = counts.filter(F.array_contains("ks", F.lit(k).cast("long")) & F.col("h").isNotNull()).select("h", "n").toPandas()
        seen = own["h"].to_numpy(np.int64).view(_U), own["n"].to_numpy(np.int64)
        yield blocks - 1 - k, spark.sparkContext.broadcast(Index(rows, total.n if total else 0, seen))


def search(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(doc_id, contaminated, n_items, best, item_ids)``, one row per row of ``docs``.

    Items with fewer than five words count as one shingle; items without words and null texts
    match nothing. The benchmark is worked through in blocks of bounded size, each against
    all documents; the rows are written between blocks, so a task holds one block.
    """
    schema = "doc_id string, n_items int, best double, item_ids array<long>"
    start = [F.lit(0).alias("n_items"), F.lit(0.0).alias("best"), F.array().cast("array<long>").alias("item_ids")]
    found = docs.select(F.col(id_col).cast("string").alias("doc_id"), *start, F.col(text).alias("t"))
    for more, index in _indexes(docs, benchmark, item, item_text):
        # Texts come back only where another block follows.
        found = found.mapInPandas(_searcher(index, bool(more)), schema + ", t string" * bool(more))
        found = settle(found, "decontaminate-found") if more else found
    ids = F.array_sort("item_ids").alias("item_ids")
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("n_items") > 0).alias("contaminated"), "n_items", "best", ids)


def _searcher(index: Broadcast, with_text: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            new = [index.value.search(t) for t in frame["t"]]
            out = frame if with_text else frame.drop(columns="t")
            yield out.assign(
                n_items=[n + len(f) for n, f in zip(frame["n_items"], new)],
                best=[max([b, *(v for _, v in f)]) for b, f in zip(frame["best"], new)],
                item_ids=[[*old, *(i for i, _ in f if i is not None)] for old, f in zip(frame["item_ids"], new)],
            )

    return run


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    kept = docs
    for more, index in _indexes(docs, benchmark, item, item_text):
        kept = kept.mapInArrow(_keeper(index, text), docs.schema)
        kept = settle(kept, "decontaminate-kept") if more else kept
    return kept


def _keeper(index: Broadcast, text: str):
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield batch.filter(pa.array([not index.value.search(t) for t in texts], pa.bool_()))

    return run
