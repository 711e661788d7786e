"""Byte-level BPE by recursive DuckDB queries, one small database in each worker.

A text is cut before single spaces, where a pre-token always begins, so that most of it is
looked up; the distinct pre-tokens not seen before become rows ``(word, position, token)``, one
a byte. A recursive query joins each row and its neighbour with the merge table and contracts,
in every word, the leftmost pair of the smallest rank, until no word has a pair left. The
ids are decoded by a join with the vocabulary and ordered aggregation. A worker decodes the ids
of each distinct pre-token once; a text whose pre-tokens all give their own bytes back decodes to
its own bytes.

A pre-token over ``LONG`` bytes is encoded in windows that overlap. Two windows are spliced
where both have the same token at the same place, after the same or another token of the left
one: BPE of a string is the one sequence of tokens in which all neighbours stay apart under
merging, and then all neighbours of the spliced sequence do. Overlaps without such a place are
widened.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import prepare

LONG = 256
OVERLAP = 64
WIDEN = 4
BATCH_WORDS = 20_000
BATCH_BYTES = 1 << 20
PART_SIGNS = 4 << 20
MEMO = 700_000

# White space as the pattern's engine has it; before these a space does not begin a pre-token.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_AFTER_SPACE = [" " + c for c in _SPACES if c.isascii()], [" " + c for c in _SPACES]

# A row has its token, the place after it, the next token, and rank and place of the pair of both.
# ``n`` counts the contractions; a word's rows of the highest ``n`` are its fixpoint.
_IDS = """
WITH RECURSIVE state(w, p, t, np, nx, k, n) AS (
  SELECT s.w, s.p, s.t, s.p + 1, s.nx, (m.r::BIGINT << 32) | s.p, 0
  FROM start s LEFT JOIN merges m ON m.k = (s.t::BIGINT << 32) | s.nx
  UNION ALL
  SELECT c.w, c.p, c.t, c.np, c.nx, CASE WHEN c.changed THEN (m.r::BIGINT << 32) | c.p ELSE c.k END, c.n + 1
  FROM (
    SELECT s.w, s.p, s.n, s.k, s.p = b.at OR s.np = b.at AS changed,
           CASE WHEN s.p = b.at THEN b.r ELSE s.t END AS t,
           CASE WHEN s.p = b.at THEN q.np ELSE s.np END AS np,
           CASE WHEN s.p = b.at THEN q.nx WHEN s.np = b.at THEN b.r ELSE s.nx END AS nx
    FROM state s
    JOIN (
      SELECT w, (best >> 32)::INT AS r, (best & 4294967295)::INT AS at, gone
      FROM (SELECT w, min(k) AS best, arg_min(np, k) AS gone FROM state WHERE k IS NOT NULL GROUP BY w)
    ) b ON s.w = b.w
    LEFT JOIN state q ON q.p = CASE WHEN s.p = b.at THEN b.gone END
    WHERE s.p <> b.gone
  ) c LEFT JOIN merges m ON m.k = CASE WHEN c.changed THEN (c.t::BIGINT << 32) | c.nx END
)
SELECT s.w, s.p, s.t
FROM state s JOIN (SELECT w, max(n) AS n FROM state GROUP BY w) l ON l.w = s.w AND l.n = s.n
ORDER BY s.p
"""
_BYTES = """
SELECT w, unhex(string_agg(v.h, '' ORDER BY p)) AS b FROM coded JOIN vocabulary v ON coded.t = v.t GROUP BY w
"""


class BytePairs:
    """Ranks of a vocabulary and a pre-token pattern, in a database of its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb

        self.pattern = regex.compile(pattern)
        self.whole = ranks
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        # A pair of tokens merges into the token that both together spell; its rank is its id.
        pairs = [
            ((ranks[t[:k]] << 32) | ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
        ]
        merges = pd.DataFrame(pairs, columns=["k", "r"])  # noqa: F841  (read by name)
        words = pd.DataFrame({"t": ranks.values(), "h": [t.hex() for t in ranks]})  # noqa: F841
        self.db = duckdb.connect(config={"threads": 1})
        self.db.execute("SET temp_directory = ''")
        self.db.execute("CREATE TABLE merges AS SELECT k::BIGINT AS k, r::INT AS r FROM merges")
        self.db.execute("CREATE TABLE vocabulary AS SELECT t::INT AS t, h FROM words")
        # Ids as little-endian 32-bit integers.
        self.words: dict[str, bytes] = {}
        # Without the space that they begin with; ``heads`` are those at the start of a text.
        self.chunks: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        # Pre-tokens whose ids decode to something else: none, unless the vocabulary is odd.
        self.odd: dict[str, bytes] = {}

    def contract(self, raw: list[bytes]) -> list[bytes]:
        """Ids of byte strings by merging alone, as little-endian 32-bit integers."""
        out = [b""] * len(raw)
        at = 0
        while at < len(raw):
            end, size = at, 0
            while end < len(raw) and end - at < BATCH_WORDS and (end == at or size + len(raw[end]) <= BATCH_BYTES):
                size += len(raw[end])
                end += 1
            token = self.byte[np.frombuffer(b"".join(raw[at:end]), np.uint8)]
            word = np.repeat(np.arange(at, end, dtype=np.int32), [len(r) for r in raw[at:end]])
            after = pd.array(np.append(token[1:], 0)[: len(token)], "Int32")
            after[np.append(word[1:] != word[:-1], True)[: len(word)]] = pd.NA
            # Places count through the batch, so that one number names a row.
            start = pd.DataFrame({"w": word, "p": np.arange(len(token), dtype=np.int32), "t": token, "nx": after})  # noqa: F841
            done = self.db.execute(_IDS).fetchnumpy()
            edges = np.flatnonzero(np.diff(done["w"], prepend=-1))
            flat, ends = done["t"].astype("<i4").tobytes(), [*(4 * edges[1:]).tolist(), 4 * len(done["t"])]
            for w, a, b in zip(done["w"][edges].tolist(), (4 * edges).tolist(), ends):
                out[w] = flat[a:b]
            at = end
        return out

    def encode_bytes(self, raw: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens of any length."""
        out = [b""] * len(raw)
        short = [k for k, r in enumerate(raw) if r not in self.whole and len(r) <= LONG]
        for k, ids in zip(short, self.contract([raw[k] for k in short])):
            out[k] = ids
        for k, r in enumerate(raw):
            if r in self.whole:
                # A pre-token that is itself a token is not merged.
                out[k] = np.array([self.whole[r]], "<i4").tobytes()
            elif len(r) > LONG:
                out[k] = self.encode_long(r)
        return out

    def encode_long(self, raw: bytes, overlap: int = OVERLAP) -> bytes:
        while True:
            size = max(LONG, 2 * overlap)
            starts = list(range(0, max(1, len(raw) - overlap), size))
            parts = self.contract([raw[s : s + size + overlap] for s in starts])
            spliced = self._splice(starts, [np.frombuffer(p, "<i4") for p in parts])
            if spliced is not None:
                return spliced.tobytes()
            overlap *= WIDEN

    def _splice(self, starts: list[int], parts: list[np.ndarray]) -> np.ndarray | None:
        length = self.lengths
        out, entry = [], 0
        for k, ids in enumerate(parts):
            places = starts[k] + np.cumsum([0, *length[ids[:-1]]]) if len(ids) else np.zeros(0, np.int64)
            first = int(np.searchsorted(places, entry))
            if k + 1 == len(parts):
                out.append(ids[first:])
                break
            after = starts[k + 1] + np.cumsum([0, *length[parts[k + 1][:-1]]])
            here = dict(zip(places.tolist(), ids.tolist()))
            # The left window has a token before the place, the right one began earlier still.
            shared = [
                p for p, t in zip(after.tolist(), parts[k + 1].tolist()) if p > starts[k + 1] and p > entry and here.get(p) == t
            ]
            if not shared:
                return None
            entry = shared[len(shared) // 2]
            out.append(ids[first : int(np.searchsorted(places, entry))])
        return np.concatenate(out)

    @property
    def lengths(self) -> np.ndarray:
        if not hasattr(self, "_lengths"):
            self._lengths = np.zeros(max(self.whole.values()) + 1, np.int64)
            for t, r in self.whole.items():
                self._lengths[r] = len(t)
        return self._lengths

    def decode_many(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each sequence of ids: rows joined with the vocabulary, aggregated in order."""
        out = [b""] * len(ids)
        lens = np.array([len(x) for x in ids], np.int64)
        parts = np.cumsum(lens) // BATCH_BYTES
        edges = np.flatnonzero(np.diff(parts, prepend=-1)).tolist()
        for a, b in zip(edges, [*edges[1:], len(ids)]):
            flat = np.concatenate([np.zeros(0, np.int32), *ids[a:b]]).astype(np.int32)
            if len(flat) and (int(flat.min()) < 0 or int(flat.max()) >= len(self.lengths) or not self.lengths[flat].all()):
                raise ValueError("an id is not in the vocabulary")
            place = np.arange(len(flat)) - np.repeat(np.cumsum(lens[a:b]) - lens[a:b], lens[a:b])
            coded = pd.DataFrame({"w": np.repeat(np.arange(a, b), lens[a:b]), "p": place, "t": flat})  # noqa: F841
            for w, raw in self.db.execute(_BYTES).fetchall():
                out[w] = bytes(raw)
        return out

    def learn(self, heads: list[str], chunks: list[str]) -> None:
        """Encode what is not known yet by its distinct pre-tokens, and decode their ids."""
        cut = [self.pattern.findall(c) for c in [*heads, *(" " + c for c in chunks)]]
        new = list({w for ws in cut for w in ws if w not in self.words})
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        ids = self.encode_bytes(raw)
        self.words.update(zip(new, ids))
        for w, r, back in zip(new, raw, self.decode_many([np.frombuffer(i, "<i4") for i in ids])):
            if back != r:
                self.odd[w] = back
        coded = [self.words[ws[0]] if len(ws) == 1 else b"".join([self.words[w] for w in ws]) for ws in cut]
        self.heads.update(zip(heads, coded))
        self.chunks.update(zip(chunks, coded[len(heads) :]))

    def run(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """Ids of whole texts, and the bytes that those ids decode to."""
        for memo in (self.words, self.chunks, self.heads):
            if len(memo) > MEMO:
                # The older half goes.
                for key in list(memo)[: len(memo) // 2]:
                    del memo[key]
        cut = [split(t) for t in texts]
        found = [list(map(self.chunks.get, cs)) for _, cs in cut]
        heads = {h for h, _ in cut if h not in self.heads}
        missing = [k for k, f in enumerate(found) if None in f]
        if missing or heads:
            self.learn(list(heads), list({c for k in missing for c, f in zip(cut[k][1], found[k]) if f is None}))
            for k in missing:
                found[k] = list(map(self.chunks.__getitem__, cut[k][1]))
        ids = [np.frombuffer(self.heads[h] + b"".join(f), "<i4") for (h, _), f in zip(cut, found)]
        if self.odd:
            return list(zip(ids, self.decode_many(ids)))
        # Every pre-token decoded to its own bytes, so the whole does.
        return [(i, t.encode("utf-8", "surrogatepass")) for i, t in zip(ids, texts)]


def split(text: str) -> tuple[str, list[str]]:
    """Cuts a text before spaces that begin a pre-token, those before another sign: what comes
    before the first such space, and the parts after each."""
    head, *parts = text.split(" ")
    odd = _AFTER_SPACE[0 if text.isascii() else 1]
    if text.endswith(" ") or any(o in text for o in odd):
        joined = [head]
        for part in parts:
            # A space before white space, or at the end, may belong to the run before it.
            if not part or part[0] in _SPACES:
                joined[-1] += " " + part
            else:
                joined.append(part)
        head, *parts = joined
    return head, parts


@lru_cache(maxsize=2)
def byte_pairs(path: str, pattern: str) -> BytePairs:
    with open(path, "rb") as lines:
        return BytePairs({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, ids, decoded)``, one row per row of ``docs``.

    ``ids`` are those of the whole text without special tokens, ``decoded`` the bytes that they
    stand for. A null text is an empty one and has no ids; a null id stays; other columns do
    not matter. ``ranks`` is the path of a file of base64 tokens and ranks that every executor
    can read, ``pattern`` the pre-token pattern.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = byte_pairs(ranks, pattern)
        for frame in frames:
            # A bounded number of signs at a time: ids take about as much room as the text.
            for _, part in frame.groupby(frame["t"].str.len().cumsum() // PART_SIGNS):
                ids, decoded = zip(*use.run(part["t"].tolist()))
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "ids": list(ids), "decoded": list(decoded)})

    prepare(docs.sparkSession)
    thin = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    made = thin.mapInPandas(run, "doc_id string, ids array<int>, decoded binary")
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def decode(coded: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``coded`` with a column ``decoded``: the bytes of its ids; null ids give null."""
    from pyspark.sql import types as T

    schema = T.StructType([f for f in coded.schema.fields if f.name != "decoded"] + [T.StructField("decoded", T.BinaryType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = byte_pairs(ranks, pattern)
        for frame in frames:
            known = frame[ids].notna().to_numpy()
            raw = iter(use.decode_many([np.asarray(x, np.int32) for x in frame[ids][known]]))
            yield frame.assign(decoded=pd.Series([next(raw) if k else None for k in known], index=frame.index, dtype=object))

    prepare(coded.sparkSession)
    return coded.drop("decoded").mapInPandas(run, schema)
