"""SentencePiece encoding and decoding by a shared-prefix forward pass.

A text is marked (a leading space, spaces as ``▁``) and cut into marked words, over which no
piece reaches. The distinct words of a task are sorted; walking them in order is a
depth-first walk of their trie, and the forward states of a common prefix are kept, not
computed again. For a unigram model a state is the best score of the prefix (Viterbi). For a
BPE model scores do not add up; there the state is the last piece of the prefix, which is
unique: it is the piece whose join with the last piece before it is stable under merging.
Both give the library's pieces.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import prepare

MARK = "▁"
_WORDS = re.compile(f"{MARK}+[^{MARK}]*")
_MEMO_WORDS = 700_000
_MEMO_PAIRS = 1_000_000


class Pieces:
    """The pieces of a model with scores and ids, and the ids of the 256 bytes."""

    def __init__(self, scores: dict[str, float], ids: dict[str, int], byte_ids: list[int], bpe: bool, unknown: int = 0):
        self.scores, self.ids, self.byte_ids, self.bpe, self.unknown = scores, ids, byte_ids, bpe, unknown
        self.lowest = min(scores.values(), default=0.0) - 10
        found: dict[str, set[int]] = {}
        for piece in scores:
            if len(piece) > 1:
                found.setdefault(piece[-3:], {1}).add(len(piece))
        for tail, sizes in found.items():
            sizes |= found.get(tail[-2:], set()) if len(tail) == 3 else set()
        #: Lengths of the pieces with a given end of two or three characters, the longest first.
        self.sizes = {tail: tuple(sorted(sizes, reverse=True)) for tail, sizes in found.items()}
        top = max([*ids.values(), *byte_ids, unknown, 0]) + 1
        self.raw = [b""] * top
        self.is_byte = np.zeros(top, bool)
        for piece, i in ids.items():
            self.raw[i] = piece.replace(MARK, " ").encode("utf-8", "surrogatepass")
        for b, i in enumerate(byte_ids):
            self.raw[i], self.is_byte[i] = bytes([b]), True
        self.memo: dict[str, bytes] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.vocab_size())
        plain = [i for i in every if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        ids = {sp.id_to_piece(i): i for i in plain}
        scores = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        coded = {sp.id_to_piece(i): i for i in every if sp.is_byte(i)}
        byte_ids = [coded[f"<0x{b:02X}>"] for b in range(256)] if len(coded) == 256 else []
        if any(MARK in p.lstrip(MARK) for p in ids):
            raise ValueError("the model has pieces that reach over words")
        # Scores of a BPE model are the negated ranks of its merges.
        joined = sorted(s for p, s in scores.items() if len(p) > 1)
        bpe = len(joined) > 1 and all(s == int(s) for s in joined) and len(set(joined)) > 1
        return cls(scores, ids, byte_ids, bpe, sp.unk_id())

    def merged(self, text: str) -> list[str]:
        """Merging step by step: the best-scored neighbouring pair first, the left one on ties."""
        now = list(text)
        while len(now) > 1:
            found = [(-self.scores[a + b], k) for k, (a, b) in enumerate(zip(now, now[1:])) if a + b in self.scores]
            if not found:
                break
            k = min(found)[1]
            now[k : k + 2] = [now[k] + now[k + 1]]
        return now

    def stable(self, left: str, right: str) -> bool:
        """Whether merging the joined text of two pieces ends at just these two."""
        known = self.pairs.setdefault(left, {}).get(right)
        if known is None:
            known = self.pairs[left][right] = self.merged(left + right) == ([left, right] if left else [right])
            self.n_pairs += 1
        return known

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """The pieces of each distinct word, in sorted order."""
        step = self._last_stable if self.bpe else self._best_sum
        before, last, best = "", [""], [0.0]
        for word in sorted(set(words)):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], best[shared + 1 :]
            step(word, last, best)
            before, at, out = word, len(word), []
            while at:
                out.append(last[at])
                at -= len(last[at])
            out.reverse()
            yield word, out

    def _candidates(self, word: str, end: int) -> tuple[int, ...]:
        """Lengths that a piece ending at ``end`` may have."""
        return self.sizes.get(word[max(0, end - 3) : end]) or self.sizes.get(word[max(0, end - 2) : end], (1,))

    def _last_stable(self, word: str, last: list[str], best: list[float]) -> None:
        """Forward states of a BPE model: at every end the one piece that stays apart from the piece before it."""
        scores, sizes, pairs = self.scores, self.sizes, self.pairs
        for end in range(len(last), len(word) + 1):
            tail = word[end - 3 : end] if end > 2 else word[:end]
            for size in sizes.get(tail) or sizes.get(tail[-2:], (1,)):
                if size > end:
                    continue
                piece = word[end - size : end]
                if size > 1 and piece not in scores:
                    continue
                left = last[end - size]
                after = pairs.get(left)
                known = after.get(piece) if after is not None else None
                if known or known is None and self.stable(left, piece):
                    last.append(piece)
                    break

    def _best_sum(self, word: str, last: list[str], best: list[float]) -> None:
        """Forward states of a unigram model: the piece that ends the path of the best sum; the longest on ties."""
        for end in range(len(last), len(word) + 1):
            found, top = word[end - 1 : end], float("-inf")
            for size in self._candidates(word, end):
                piece = word[end - size : end] if size <= end else ""
                if piece in self.scores or size == 1:
                    score = best[end - size] + self.scores.get(piece, self.lowest)
                    if score > top:
                        found, top = piece, score
            last.append(found)
            best.append(top)

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words not known yet; a word is kept without its first mark."""
        if len(self.memo) > _MEMO_WORDS:
            _drop_older(self.memo)
        if self.n_pairs > _MEMO_PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        for word, parts in self.walk([MARK + w for w in words if w not in self.memo]):
            self.memo[word[1:]] = array("i", self._ids_of(parts)).tobytes()

    def _ids_of(self, parts: list[str]) -> list[int]:
        try:
            return [self.ids[part] for part in parts]
        except KeyError:  # not a piece: its bytes, or one unknown for a run of such
            pass
        out: list[int] = []
        for part in parts:
            i = self.ids.get(part)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, the same as the library's."""
        cut = [_words(t) for t in texts]
        self.learn({w for words in cut for w in words})
        return [np.frombuffer(b"".join(map(self.memo.__getitem__, words)), np.int32) for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "replace")


def _words(text: str) -> list[str]:
    """The marked words of a text, each without its first mark."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " " or MARK in text:
        return [w[1:] for w in _WORDS.findall(MARK + text.replace(" ", MARK))]
    return text.split(" ")


def _drop_older(memo: dict) -> None:
    """The half that was learnt first goes."""
    for key in list(memo)[: len(memo) // 2]:
        del memo[key]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces.load(path)


def encode(docs: DataFrame, model: str, text: str = "text", id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_bytes, n_pieces, n_byte_pieces, ids_sha256, round_trip[, ids])``.

    Whole texts; a null text is an empty one and has no pieces. ``round_trip`` says whether the
    decoded ids are the text, which holds unless the text has the character ``▁`` itself, which
    the model reads as a space. ``model`` is the path of a model file that every executor can
    read. ``ids_sha256`` is over the ids as little-endian 32-bit integers.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = pieces(model)
        for frame in frames:
            texts = frame["t"].tolist()
            ids = use.encode(texts)
            out = pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n_bytes": frame["b"],
                    "n_pieces": [len(x) for x in ids],
                    "n_byte_pieces": [int(use.is_byte[x].sum()) for x in ids],
                    "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
                    "round_trip": [use.decode(x) == t for x, t in zip(ids, texts)],
                }
            )
            yield out.assign(ids=ids) if with_ids else out

    prepare(docs.sparkSession)
    thin = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    thin = thin.select("doc_id", "t", F.octet_length("t").cast("long").alias("b"))
    schema = "doc_id string, n_bytes long, n_pieces long, n_byte_pieces long, ids_sha256 string, round_trip boolean"
    made = thin.mapInPandas(run, schema + ", ids array<int>" * with_ids)
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def decode(coded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``coded`` with a column ``decoded``: the text of the ids; null ids give null."""
    from pyspark.sql import types as T

    schema = T.StructType([*coded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = pieces(model)
        for frame in frames:
            yield frame.assign(decoded=[None if x is None else use.decode(np.asarray(x)) for x in frame[ids]])

    prepare(coded.sparkSession)
    return coded.mapInPandas(run, schema)
