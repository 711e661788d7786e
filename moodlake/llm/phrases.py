"""Phrase collocations by counting quotient filters, whole and exact.

1. A task reads texts into shards of bounded size: every distinct word of a shard gets a local
   number, and the texts become arrays of numbers, 0 where a piece ends. Word counts are summed
   over the shards; words that occur ``least`` times in their language get a global id, all
   others cannot be part of a candidate and become 0 too.
2. For two, three and four words in turn, each shard packs the n-grams whose shorter parts are
   all still frequent, counts them in a quotient filter (``quotient.py``), and deals it out by
   ranges. A range's task merges the sorted filters of all shards, keeps what occurs ``least``
   times, and answers every shard with one bit an entry, which opens the next length.
3. Cuts, scores and the removal of phrases inside longer ones are joins of the frequent n-grams.

A shard sends at most one entry for an n-gram however often it occurs, ranges are even because
the values are permuted, and neither the vocabulary nor the frequent n-grams are broadcast by
this module: a shard only gets the ids of its own words and the bits of its own entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import prepare, settle
from moodlake.llm.quotient import MAX_ID_BITS, Layout

LEAST = 30
LONGEST = 4
INSIDE = 80
TOP = 2000
SHARD_BYTES = 16 << 20
RANGE_ENTRIES = 2_000_000
# Copies of each one-word count in the join, so that a word that opens very many phrases is
# met by several tasks.
SALTS = 8

_TABLE = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Numbers(dict):
    """Numbers for words as they come; the empty string and the end of a piece are fixed."""

    def __init__(self, shard: _Shard):
        super().__init__({b"": -1, b"\n": 0})
        self.shard = shard

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.shard.next = self.shard.next + 1
        return n


class _Shard:
    """Texts as numbers, until there are enough of them."""

    def __init__(self):
        self.next, self.size = 0, 0
        self.words: dict[str, _Numbers] = {}
        self.parts: list[np.ndarray] = []

    def add(self, lang: str, texts: list[str]) -> None:
        raw = b"\n".join(t.encode("utf-8", "surrogatepass") for t in texts).translate(_TABLE)
        tokens = raw.replace(b"\n", b" \n ").split(b" ")
        known = self.words.setdefault(lang, _Numbers(self))
        ids = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        self.parts += [ids[ids >= 0], np.zeros(1, np.int64)]
        self.size += len(raw)

    def rows(self, shard: int) -> Iterator[pd.DataFrame]:
        ids = np.concatenate([np.zeros(0, np.int64), *self.parts])
        counts = np.bincount(ids, minlength=self.next + 1)
        for lang, words in self.words.items():
            words = {w: i for w, i in words.items() if i > 0}
            at = np.fromiter(words.values(), np.int64, len(words))
            yield pd.DataFrame({"shard": shard, "ids": None, "lang": lang, "word": list(words), "local": at, "n": counts[at]})
        yield pd.DataFrame({"shard": [shard], "ids": [_squeeze(ids)], "lang": None, "word": None, "local": None, "n": None})


def _squeeze(ids: np.ndarray) -> bytes:
    """Ids as byte planes, compressed."""
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _spread(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _number_words(docs: DataFrame, text: str, lang: str, shard_bytes: int) -> DataFrame:
    """Rows ``(shard, ids)``, one a shard, and ``(shard, lang, word, local, n)``, one a word."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        now = _Shard()
        for frame in frames:
            for name, texts in frame.groupby("lang")["t"]:
                bundle, size = [], 0
                for t in texts:
                    bundle.append(t)
                    size += len(t)
                    if now.size + size >= shard_bytes:
                        now.add(name, bundle)
                        yield from now.rows(shard)
                        now, shard, bundle, size = _Shard(), shard + 1, [], 0
                if bundle:
                    now.add(name, bundle)
        if now.parts:
            yield from now.rows(shard)

    thin = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    schema = "shard long, ids binary, lang string, word binary, local long, n long"
    return settle(thin.mapInPandas(run, schema), "phrases-shards")


def _vocabulary(words: DataFrame, least: int, parts: int) -> tuple[DataFrame, int]:
    """``(lang, word, f, id)`` of the frequent words, ids from 1 without gaps, and their number."""
    kept = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    kept = settle(kept.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(parts))), "phrases-frequent")
    sizes = sorted((r.part, r.n) for r in kept.groupBy("part").agg(F.count("*").alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    offsets = kept.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(sizes, before)], "part long, before long"
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy("lang", "word")).cast("long")
    numbered = kept.withColumn("place", place).join(offsets, "part")
    return settle(numbered.select("lang", "word", "f", (F.col("before") + F.col("place")).alias("id")), "phrases-ids"), before[-1]


def _thin(ids: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leave out what no open n-gram touches, one 0 for each stretch; ``alive`` marks the first
    words of open pairs (or the words themselves)."""
    keep = alive.copy()
    keep[1:] |= alive[:-1]
    ids = np.where(keep, ids, 0)
    stay = (ids > 0) | np.concatenate([[False], ids[:-1] > 0])
    return ids[stay], alive[stay]


def _open(ids: np.ndarray, n: int, alive: np.ndarray) -> np.ndarray:
    """Places where an ``n``-gram begins whose two ``n - 1``-grams are frequent."""
    if len(ids) < n:
        return np.zeros(0, np.int64)
    return np.flatnonzero(alive[: len(ids) - n + 1] & alive[1 : len(ids) - n + 2])


def _keys(ids: np.ndarray, at: np.ndarray, lay: Layout):
    return lay.count(*lay.permute(*lay.pack([ids[at + k] for k in range(lay.n)])))


def _filters(shard: int, ids: np.ndarray, alive: np.ndarray, lay: Layout, parts: int) -> pd.DataFrame:
    """A shard's filter of ``lay.n``-grams by ranges, and the state the next length needs."""
    left, right, counts, _ = _keys(ids, _open(ids, lay.n, alive), lay)
    ranges = lay.ranges(left, parts)
    edges = np.flatnonzero(np.diff(ranges, prepend=-1, append=parts) != 0) if len(left) else np.zeros(1, np.int64)
    rows = [
        (shard, int(ranges[a]), lay.write(left[a:b], right[a:b], counts[a:b], parts), None, None)
        for a, b in zip(edges[:-1], edges[1:])
    ]
    rows.append((shard, None, None, _squeeze(ids), np.packbits(alive).tobytes()))
    return pd.DataFrame(rows, columns=["shard", "range", "entries", "ids", "alive"])


_STATE = "shard long, range long, entries binary, ids binary, alive binary"


def _first_filters(bits: int, parts: int):
    def run(key, shards: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        ids = _spread(shards["ids"].iloc[0])
        known = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
        known[names["local"].to_numpy()] = names["id"].to_numpy()
        ids = known[ids]
        ids, alive = _thin(ids, ids > 0)
        return _filters(int(shards["shard"].iloc[0]), ids, alive, Layout(2, bits), parts)

    return run


def _next_filters(bits: int, n: int, parts: int):
    def run(key, shards: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        row, lay = shards.iloc[0], Layout(n - 1, bits)
        ids = _spread(row["ids"])
        alive = np.unpackbits(np.frombuffer(row["alive"], np.uint8), count=len(ids)).astype(bool)
        at = _open(ids, n - 1, alive)
        place = _keys(ids, at, lay)[3]
        said = replies.sort_values("range")
        yes = [np.unpackbits(np.frombuffer(b, np.uint8), count=c) for b, c in zip(said["bits"], said["n"])]
        yes = np.concatenate([np.zeros(0, np.uint8), *yes]).astype(bool)
        now = np.zeros(len(ids), bool)
        now[at[yes[place]]] = True
        if n == 3:
            ids, now = _thin(ids, now)
        return _filters(int(row["shard"]), ids, now, Layout(n, bits), parts)

    return run


def _merge(bits: int, n: int, least: int):
    lay = Layout(n, bits)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        read = [lay.read(b) for b in frame["entries"]]
        sizes = [len(r[0]) for r in read]
        left, right, counts, place = lay.count(*(np.concatenate([r[k] for r in read]) for k in range(3)))
        good = counts >= least
        words = lay.unpack(*lay.restore(left[good], right[good]))
        ends = np.cumsum(sizes)
        said = [np.packbits(good[place[e - s : e]]).tobytes() for s, e in zip(sizes, ends)]
        grams, none = list(np.stack(words, 1)), [None] * len(frame)
        blank = [None] * len(grams)
        return pd.DataFrame(
            {
                "ids": pd.Series(grams + none, dtype=object),
                "f": pd.array([*counts[good].tolist(), *none], "Int64"),
                "shard": pd.array([*blank, *frame["shard"].tolist()], "Int64"),
                "range": pd.array([*blank, *frame["range"].tolist()], "Int64"),
                "bits": pd.Series(blank + said, dtype=object),
                "n": pd.array([*blank, *sizes], "Int64"),
            }
        )

    return run


def frequent_grams(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, shard_bytes: int = SHARD_BYTES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words ``(lang, word, f, id)``, n-grams ``(ids, f)`` of two to four words, each with at least
    ``least`` occurrences in its language, and ``(lang, n)``, the number of all its words.

    Ids are those of words in a language, so an n-gram's ids name its language too.
    """
    spark = prepare(docs.sparkSession)
    shards = _number_words(docs, text, lang, shard_bytes)
    counted = shards.filter("word is not null")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words, size = _vocabulary(counted, least, tasks)
    bits = max(1, int(size).bit_length())
    if bits > MAX_ID_BITS:
        raise ValueError(f"{size} frequent words need ids of more than {MAX_ID_BITS} bits")

    def ranges(found: DataFrame) -> int:
        most = found.agg(F.sum("f")).first()[0] or 0
        return max(tasks, -(-int(most) // RANGE_ENTRIES))

    names = counted.join(words, ["lang", "word"]).select(F.col("shard").alias("of"), "local", "id")
    blobs = shards.filter("ids is not null").select("shard", "ids")
    made = blobs.groupBy("shard").cogroup(names.groupBy("of")).applyInPandas(_first_filters(bits, ranges(words)), _STATE)
    grams = None
    for n in range(2, LONGEST + 1):
        made = settle(made, f"phrases-filters-{n}")
        entries = made.filter("entries is not null").select("shard", "range", "entries")
        schema = "ids array<long>, f long, shard long, range long, bits binary, n long"
        merged = settle(entries.groupBy("range").applyInPandas(_merge(bits, n, least), schema), f"phrases-merged-{n}")
        found = merged.filter("f is not null").select("ids", "f")
        grams = found if grams is None else grams.unionAll(found)
        if n < LONGEST:
            state = made.filter("ids is not null").select("shard", "ids", "alive")
            said = merged.filter("bits is not null").select(F.col("shard").alias("of"), "range", "bits", "n")
            made = state.groupBy("shard").cogroup(said.groupBy("of")).applyInPandas(
                _next_filters(bits, n + 1, ranges(found)), _STATE
            )
    return words, grams, totals


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, inside: int = INSIDE,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best phrases of 2 to 4 words.

    ``a`` is the number of occurrences of the phrase within pieces, ``l`` and ``r`` those of the
    two parts of its lowest-scoring cut, ``n`` all words of the language, and ``score`` is
    ``2000000 a / (l + r)`` rounded down. A phrase inside a longer candidate with at least
    ``inside`` hundredths of its occurrences is left out. A null text is empty, a null language
    is ``und``; repeated rows count again; a language without candidates and an empty table give
    no rows. Ties go to the smaller phrase in the order of its bytes.
    """
    words, grams, totals = frequent_grams(docs, text, lang, least, shard_bytes)
    size = F.size("ids")
    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = grams.select("ids", "f", cut)
    sides = F.explode(
        F.array(
            F.struct(F.lit(True).alias("is_left"), F.slice("ids", F.lit(1), F.col("k")).alias("part")),
            F.struct(F.lit(False).alias("is_left"), F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("part")),
        )
    ).alias("s")
    salt = F.when(F.size("part") == 1, F.pmod(F.xxhash64("ids", "k"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    asked = cuts.select("ids", "f", "k", sides).select("ids", "f", "k", "s.is_left", "s.part").withColumn("salt", salt)
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    one = words.select(F.array("id").alias("part"), F.col("f").alias("part_f"), F.col("lang").alias("part_lang"), spread)
    many = grams.select(
        F.col("ids").alias("part"), F.col("f").alias("part_f"), F.lit(None).cast("string").alias("part_lang"), F.lit(0).cast("long").alias("salt")
    )
    told = asked.join(one.unionAll(many.filter(F.size("part") < LONGEST)), ["part", "salt"])
    by_cut = told.groupBy("ids", "f", "k").agg(
        F.max(F.when(F.col("is_left"), F.col("part_f"))).alias("l"),
        F.max(F.when(~F.col("is_left"), F.col("part_f"))).alias("r"),
        F.max("part_lang").alias("lang"),
    )
    wide = F.col("f").cast("decimal(25,0)")
    score = F.expr("(cast(f as decimal(25,0)) * 2000000) div (cast(l as decimal(25,0)) + r)").cast("long")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "lang"))
    scored = by_cut.groupBy("ids", "f").agg(lowest.alias("c"), F.max("lang").alias("lang"))
    subs = F.expr(
        "flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), i -> slice(ids, i, m))))"
    )
    longer = grams.filter(size > 2).select(F.explode(subs).alias("ids"), F.col("f").alias("over"))
    longer = longer.groupBy("ids").agg(F.max("over").alias("over"))
    left_out = F.col("over").isNotNull() & (F.col("over").cast("decimal(25,0)") * 100 >= wide * inside)
    stay = scored.join(longer, "ids", "left").filter(~left_out)
    stay = stay.select("ids", F.col("f").alias("a"), "c.l", "c.r", "c.score", "lang")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # Ties with the last place stay until their words are known.
    best = settle(stay.withColumn("tied", F.rank().over(by_score)).filter(F.col("tied") <= top), "phrases-best")
    each = best.select("ids", F.posexplode("ids").alias("at", "id"))
    spelt = each.join(words.select("id", "word"), "id").groupBy("ids").agg(
        F.sort_array(F.collect_list(F.struct("at", F.col("word").cast("string").alias("w")))).alias("ws")
    )
    named = best.join(spelt.select("ids", F.array_join(F.col("ws.w"), " ").alias("phrase")), "ids").join(totals, "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    return named.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
