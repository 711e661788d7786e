"""Token counts of whole texts by overlap resynchronisation.

A huge text is cut into chunks that overlap. Each chunk is encoded alone, with the offset of
every pre-token. A cut is proven when both neighbours have a pre-token boundary at the same
place: the left chunk's boundaries are right up to its margin, since it began at a right one,
and pre-tokenisation from a shared boundary on depends only on what follows. Merges never
cross a pre-token boundary, so the counts on both sides of the cut add up exactly. Where two
neighbours share no boundary, the text is tried again with a wider overlap.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import prepare, settle

CHUNK = 16_384
OVERLAP = 256
WIDEN = 8

# The byte-level pre-tokenizer's public pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Letters and signs whose Unicode classes are the same in every version of the tables. White
# space that engines class differently is left out.
_PLAIN = re.compile("[^\t\n\r\x20-\x7e¡-ɏ‐-‧]")
_MEMO_WORDS = 400_000


class Encoder:
    """Exact counts for one tokenizer file, and the pre-token boundaries they hold at."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        step = spec.get("pre_tokenizer") or {}
        self.splits = (
            step.get("type") == "ByteLevel"
            and step.get("use_regex", True)
            and not step.get("add_prefix_space")
            and not spec.get("normalizer")
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
            and all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
        )
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.margin = max([16, *(len(t) + 2 for t in self.added)])
        self.pattern = regex.compile("|".join([*map(regex.escape, self.added), PATTERN]))
        self.memo: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text. Pre-tokens are counted once and remembered; a text with unusual
        characters or added tokens goes to the library whole."""
        plain = [self.plain(t) for t in texts]
        words = [self.pattern.findall(t) if p else None for t, p in zip(texts, plain)]
        self.learn(words)
        get = self.memo.__getitem__
        out = [sum(map(get, ws)) if ws is not None else -1 for ws in words]
        for k in [k for k, p in enumerate(plain) if not p]:
            out[k] = len(self.library.encode(texts[k], add_special_tokens=False).ids)
        return out

    def plain(self, text: str) -> bool:
        return self.splits and not _PLAIN.search(text) and not any(a in text for a in self.added)

    def learn(self, words: list[list[str] | None]) -> None:
        """Count the pre-tokens not counted yet."""
        new = list({w for ws in words if ws for w in ws if w not in self.memo})
        if len(self.memo) + len(new) > _MEMO_WORDS:
            self.memo = {}
            new = list({w for ws in words if ws for w in ws})
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            got = self.library.encode_batch_fast(part, add_special_tokens=False)
            self.memo.update(zip(part, (len(e.ids) for e in got)))

    def boundaries(self, text: str) -> tuple[list[int], list[int]]:
        """Starts of the pre-tokens and the tokens before each, with the end of the text last."""
        if self.plain(text):
            words = self.pattern.findall(text)
            self.learn([words])
            ends = np.cumsum([0, *map(len, words)])
            return ends.tolist(), np.cumsum([0, *map(self.memo.__getitem__, words)]).tolist()
        coded = self.library.encode(text, add_special_tokens=False)
        starts, before, last = [0], [0], object()
        added = {self.library.token_to_id(a) for a in self.added}
        for k, (word, (start, _), i) in enumerate(zip(coded.word_ids, coded.offsets, coded.ids)):
            if k and (word != last or i in added):
                # Offsets leave out a leading space, which belongs to the pre-token.
                at = start - 1 if start and i not in added and text[start - 1] == " " and _leads(coded, k) else start
                if at > starts[-1]:
                    starts.append(at)
                    before.append(k)
            last = word if i not in added else object()
        return [*starts, len(text)], [*before, len(coded.ids)]


def _leads(coded, k: int) -> bool:
    return coded.tokens[k].startswith("Ġ")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(text: str, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Spans of ``chunk`` characters, each with ``overlap`` more on its right."""
    n = len(text)
    return [(s, min(n, s + chunk + overlap)) for s in range(0, max(n, 1), chunk)]


def splice(chunks: list[tuple[int, int, list[int], list[int]]]) -> int | None:
    """Tokens of the text from its chunks, or None if two neighbours share no boundary.

    A chunk is ``(start, safe end, starts, tokens before)``, in places of the whole text. Its
    starts are right up to the safe end once its first used one is.
    """
    total, entry = 0, 0
    for here, after in zip(chunks, [*chunks[1:], None]):
        marks = dict(zip(here[2], here[3]))
        if after is None:
            return total + here[3][-1] - marks[entry]
        later = set(after[2])
        shared = [m for m in here[2] if m in later and entry <= m <= here[1]]
        if not shared:
            return None
        total += marks[shared[0]] - marks[entry]
        entry = shared[0]
    return total


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    id_col: str = "doc_id",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    limit: int = 512,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    Counts are those of the library for the whole text, without begin and end tokens; a null
    text is an empty one and a null id stays. Texts longer than ``chunk`` are cut, their
    chunks dealt over the cluster, and spliced. ``tokenizer`` is the path of a tokenizer
    file that every executor can read. A tokenizer whose pre-tokens cannot be proven
    independent (no byte-level pre-tokenizer) encodes every text whole.
    """
    spark = prepare(docs.sparkSession)
    whole = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    splits = encoder(tokenizer).splits
    short = whole.filter(F.length("t") <= chunk) if splits else whole

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = encoder(tokenizer)
        for frame in frames:
            texts = frame["t"].tolist()
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_bytes": frame["b"], "n_tokens": use.count(texts)})

    bytes_of = F.octet_length("t").cast("long").alias("b")
    done = short.select("doc_id", bytes_of, "t").mapInPandas(count, "doc_id string, n_bytes long, n_tokens long")
    if splits:
        long = whole.filter(F.length("t") > chunk).select("doc_id", bytes_of, F.xxhash64("t").alias("h"), "t")
        done = done.unionAll(_long_counts(spark, long, tokenizer, chunk, overlap))
    return done.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _long_counts(spark, long: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """Counts of the texts over the chunk size; wider overlaps for those that do not align."""
    pieces_schema = "doc_id string, b long, h long, n int, start long, safe long, text string"
    marks_schema = "doc_id string, b long, h long, n int, start long, safe long, starts array<long>, before array<long>"

    def pieces_of(size: int, over: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            use = encoder(tokenizer)
            for frame in frames:
                for doc, b, h, t in zip(frame["doc_id"], frame["b"], frame["h"], frame["t"]):
                    rows = [
                        (doc, b, h, k, s, e if e == len(t) else e - use.margin, t[s:e])
                        for k, (s, e) in enumerate(cut(t, size, over))
                    ]
                    yield pd.DataFrame(rows, columns=["doc_id", "b", "h", "n", "start", "safe", "text"])

        return run

    def encode(size: int, over: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            use = encoder(tokenizer)
            for frame in frames:
                rows = []
                for doc, b, h, n, s, safe, t in frame.itertuples(index=False):
                    starts, before = use.boundaries(t)
                    total = (starts[-1] + s, before[-1])
                    keep = [(a + s, c) for a, c in zip(starts[:-1], before[:-1])]
                    # Only what a neighbour can meet is sent on: the overlaps and the ends.
                    keep = [x for x in keep if x[0] - s <= over or x[0] - s >= size] + [total]
                    rows.append((doc, b, h, n, s, safe, [x[0] for x in keep], [x[1] for x in keep]))
                yield pd.DataFrame(rows, columns=["doc_id", "b", "h", "n", "start", "safe", "starts", "before"])

        return run

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        parts: dict[int, list] = {}
        for n, s, safe, starts, before in frame[["n", "start", "safe", "starts", "before"]].itertuples(index=False):
            parts[n] = [s, safe, list(starts), list(before)]
        total = splice([tuple(parts[n]) for n in sorted(parts)])
        repeats = int((frame["n"] == 0).sum())
        return pd.DataFrame({"doc_id": [first["doc_id"]] * repeats, "b": first["b"], "h": first["h"], "total": total})

    out, waiting, over = None, settle(long, "tokens-long"), overlap
    while True:
        size = max(chunk, over)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        pieces = waiting.mapInPandas(pieces_of(size, over), pieces_schema).repartition(tasks, "doc_id", "h", "n")
        marks = pieces.mapInPandas(encode(size, over), marks_schema)
        spliced = settle(
            marks.groupBy("doc_id", "h").applyInPandas(join, "doc_id string, b long, h long, total long"), "tokens-spliced"
        )
        good = spliced.filter("total is not null").select("doc_id", F.col("b").alias("n_bytes"), F.col("total").alias("n_tokens"))
        out = good if out is None else out.unionAll(good)
        failed = spliced.filter("total is null").select("doc_id", "h").distinct()
        if failed.isEmpty():
            return out
        failed = failed.select(F.col("doc_id").alias("d"), F.col("h").alias("k"))
        waiting = settle(
            waiting.join(failed, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k")), "left_semi"),
            "tokens-waiting",
        )
        over *= WIDEN
