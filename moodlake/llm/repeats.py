"""Exact removal of repeated byte strings by a depth-limited radix sort of suffixes.

A suffix matters only through its first ``WIDTH`` bytes, its window. Windows are parted by
most-significant-digit passes until equal windows stand alone:

1. The leading digit of a window is its anchor, the smallest hash of its 32-byte strings: a
   function of the window's bytes, so equal windows share anchor and place of the anchor.
   Neighbouring windows with one anchor travel as one run, with a digest of all its bytes. An
   anchor that occurs once leaves the sort. Runs that occur twice are repeated as a whole.
2. Runs left over are parted by where the anchor lies, sixteen places to a cell. A cell whose
   bytes common to all its windows occur once leaves the sort; one whose whole bytes occur
   twice is repeated.
3. The cells left over give their single windows. Equal groups are the repeated windows.

Only digests are shuffled, packed into arrays, many to a row. What a batch of documents
already proves on its own (a digit that occurs twice in it) is not sent to the task that
counts the digit but straight on, so a passage or text that a third of all documents share
adds a few entries a batch to one task. Texts move compressed, in groups of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import prepare, settle

WIDTH = 200
ANCHOR = 32
CELL = 16
BUCKET_BYTES = 8 << 20
GROUP_BYTES = 2 << 20
FLUSH = 150_000
LOCAL = 8

_U = np.uint64
_POS = _U((1 << 24) - 1)
_BLOCK = 1 << 22
# What a status says of a run, cell or window.
SURE, OPEN, PARTNER, DEAD = 1, 2, 3, 4


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def runs(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, anchor place, first and last window of each run of windows of one text."""
    anchors, places, firsts, lasts = [], [], [], []
    span = WIDTH - ANCHOR + 1
    for base in range(0, max(0, len(raw) - WIDTH + 1), _BLOCK):
        part = np.frombuffer(raw[base : base + _BLOCK + WIDTH - 1], np.uint8)
        h, step, m = part.astype(_U) + _U(1), 1, 0x9E3779B97F4A7C15
        while step < ANCHOR:
            h = h[:-step] * _U(m) + h[step:]
            m, step = (m * m + 2) & ((1 << 64) - 1) | 1, step * 2
        h = _mix(h)
        key = (h & ~_POS) | np.arange(len(h), dtype=_U)
        pad = np.concatenate([key, np.full(-len(key) % span, ~_U(0))]).reshape(-1, span)
        ahead = np.minimum.accumulate(pad, 1).ravel()
        behind = np.minimum.accumulate(pad[:, ::-1], 1)[:, ::-1].ravel()
        many = len(h) - span + 1
        at = (np.minimum(behind[:many], ahead[span - 1 : span - 1 + many]) & _POS).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:], [many]]) - 1
        anchors.append(h[at[first]])
        for out, x in ((places, at[first]), (firsts, first), (lasts, last)):
            out.append(x + base)
    if not anchors:
        return np.zeros(0, _U), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(map(np.concatenate, (anchors, places, firsts, lasts)))


def digests(raw: bytes, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """64-bit digests of parts of a text."""
    xx = xxhash.xxh3_64_intdigest
    return np.array([xx(raw[s:e], k) for s, e, k in zip(starts.tolist(), ends.tolist(), seeds.tolist())], _U)


def _pack(*columns: np.ndarray) -> bytes:
    """Arrays of one length, compressed."""
    head = np.array([len(columns[0])], np.int64).tobytes()
    return zstandard.compress(head + b"".join(np.ascontiguousarray(c).tobytes() for c in columns), 1)


def _unpack(blobs, *types: type) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in types]
    for blob in blobs:
        raw = zstandard.decompress(blob)
        n, at = int(np.frombuffer(raw, np.int64, 1)[0]), 8
        for k, t in enumerate(types):
            out[k].append(np.frombuffer(raw, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(x) for x in out]


# Entries and statuses share one form: two digests, the document, what part of it, a weight.
_FORM = (_U, _U, _U, np.int64, np.int16, np.int16, np.int64, np.int8)


class _Outbox:
    """Rows ``(bucket, blob)`` from columns of ``_FORM``, one row a bucket."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def rows(self, where: np.ndarray, columns: list[np.ndarray]) -> pd.DataFrame:
        order = np.lexsort((columns[0], where))
        where, columns = where[order], [c[order].astype(t) for c, t in zip(columns, _FORM)]
        names, at = np.unique(where, return_index=True)
        ends = [*at[1:], len(where)]
        blobs = [_pack(*(c[s:e] for c in columns)) for s, e in zip(at, ends)]
        return pd.DataFrame({"bucket": names.astype(np.int32), "blob": blobs})


def _sums(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the group of its key, and the total weight by group."""
    _, group = np.unique(key, return_inverse=True)
    return group, np.bincount(group, weight).astype(np.int64)


def _classes(lead: np.ndarray, full: np.ndarray, weight: np.ndarray):
    """Groups by leading digit and by full digest: members, totals, and classes per leading digit."""
    lead_of, lead_total = _sums(lead, weight)
    both = np.empty(len(lead), [("a", _U), ("b", _U)])
    both["a"], both["b"] = lead, full
    full_of, full_total = _sums(both, weight)
    seen, first = np.unique(full_of, return_index=True)
    kinds = np.bincount(lead_of[first], minlength=len(lead_total))
    # Classes that occur once, by leading digit.
    single = np.bincount(lead_of[first], full_total[seen] == 1, minlength=len(lead_total)).astype(np.int64)
    return lead_of, lead_total, full_of, full_total, first, kinds, single


def _send(pass_: int, columns: list[np.ndarray], buckets: int) -> Iterator[pd.DataFrame]:
    """What one batch sends: entries to the bucket of their leading digit, settled ones onward."""
    lead, full, ref, place, lo, hi, weight, code = columns
    lead_of, lead_total, full_of, full_total, first, kinds, single = _classes(lead, full, weight)
    rep = np.zeros(len(lead), bool)
    rep[first] = True
    total = full_total[full_of]
    entry = rep.copy()
    onward = np.zeros(len(lead), bool)
    status = np.zeros(len(lead), np.int8)
    if pass_ == 1:
        known = lead_total[lead_of] > 1
        onward = known
        mixed = kinds[lead_of] > 1
        status[known] = np.where(mixed & (total == 1), OPEN, SURE)[known]
        status[known & mixed & rep & (total > 1)] = PARTNER
    elif pass_ == 2:
        onward = rep & (total == 1) & (single[lead_of] > LOCAL)
        status[onward] = OPEN
    # Of many classes under one digit two tell the bucket what it must know.
    crowded = (kinds[lead_of] > LOCAL) if pass_ < 3 else np.zeros(len(lead), bool)
    if crowded.any():
        picks = np.flatnonzero(crowded & entry)
        picks = picks[np.argsort(total[picks], kind="stable")]
        picks = picks[np.argsort(lead_of[picks], kind="stable")]
        turn = np.arange(len(picks)) - np.searchsorted(lead_of[picks], lead_of[picks])
        left = kinds[lead_of[picks]] - 1
        drop = (turn > 1) & ((turn < left) if pass_ == 2 else True)
        drop &= onward[picks] | (pass_ == 1)
        entry[picks[drop]] = False
    box = _Outbox(buckets)
    cols = [lead, full, ref, place, lo, hi, np.where(entry, total, weight), np.zeros(len(lead), np.int8)]
    if entry.any():
        yield box.rows((lead % _U(buckets)).astype(np.int64)[entry], [c[entry] for c in cols])
    if onward.any():
        cols[7] = status
        yield box.rows((_mix(ref + place.astype(_U)) % _U(buckets)).astype(np.int64)[onward], [c[onward] for c in cols])


def _resolve(pass_: int, groups: int):
    """What the entries of a bucket come to, sent to the groups of their documents."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        columns = _unpack(frame["blob"], *_FORM)
        done = columns[7] > 0
        lead, full, ref, place, lo, hi, weight, _ = (c[~done] for c in columns)
        lead_of, lead_total, full_of, full_total, first, kinds, single = _classes(lead, full, weight)
        total, rep = full_total[full_of], np.zeros(len(lead), bool)
        rep[first] = True
        status = np.zeros(len(lead), np.int8)
        many = lead_total[lead_of] > 1
        if pass_ == 1:
            mixed = kinds[lead_of] > 1
            status[many] = SURE
            status[many & mixed & (total == 1)] = OPEN
            status[many & mixed & (total > 1) & rep] = PARTNER
        elif pass_ == 2:
            status[total == 1] = np.where(many, OPEN, DEAD)[total == 1]
            status[(total > 1) & rep & (single[lead_of] > 0)] = PARTNER
        else:
            status[total == 1] = DEAD
        told = status > 0
        out = [np.concatenate([c[done], x[told]]) for c, x in zip(columns, (lead, full, ref, place, lo, hi, weight, status))]
        box = _Outbox(groups).rows((out[2] % _U(groups)).astype(np.int64), out)
        return box.rename(columns={"bucket": "grp", "blob": "news"})

    return run


def _covered(n: int, windows: np.ndarray) -> np.ndarray:
    """The bytes in some repeated window."""
    turn = np.zeros(n + 1, np.int32)
    turn[: len(windows)] += windows
    turn[WIDTH : WIDTH + len(windows)] -= windows
    return np.cumsum(turn[:n]) > 0


def _answer(raw: bytes, windows: np.ndarray | None) -> tuple[int, int, str]:
    """Bytes removed, spans, and the digest of what is kept."""
    if windows is None or not windows.any():
        return 0, 0, hashlib.sha256(raw).hexdigest()
    gone = _covered(len(raw), windows)
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()


_DOC = "grp int, ref long, doc_id string, n_bytes long, z binary, flags binary, parts binary"
_OUT = _DOC + ", n_removed long, n_spans long, kept_sha256 string"


def _run_entries(raw: bytes, ref: int) -> list[np.ndarray]:
    anchor, place, first, last = runs(raw)
    full = digests(raw, first, last + WIDTH, place - first)
    n = len(anchor)
    return [anchor, full, np.full(n, ref, _U), place, place - last, place - first, np.ones(n, np.int64), np.zeros(n, np.int8)]


def _cell_entries(raw: bytes, ref: int, parts: list[np.ndarray]) -> list[np.ndarray]:
    """Cells of the open runs ``(place, lo, hi, weight)``."""
    rows = []
    for place, lo, hi, weight in zip(*(p.tolist() for p in parts)):
        for j in range(lo // CELL, hi // CELL + 1):
            rows.append((place, max(lo, j * CELL), min(hi, j * CELL + CELL - 1), weight, j * CELL))
    place, lo, hi, weight, cell = np.array(rows, np.int64).reshape(-1, 5).T
    core = digests(raw, place - cell, place - cell - CELL + 1 + WIDTH, cell)
    full = digests(raw, place - hi, place - lo + WIDTH, hi * WIDTH + lo)
    return [core, full, np.full(len(place), ref, _U), place, lo, hi, weight, np.zeros(len(place), np.int8)]


def _window_entries(raw: bytes, ref: int, parts: list[np.ndarray]) -> list[np.ndarray]:
    place, lo, hi, weight = parts
    size = hi - lo + 1
    owner = np.repeat(np.arange(len(place)), size)
    back = lo[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    start = place[owner] - back
    one, two = (digests(raw, start, start + WIDTH, np.full(len(start), k)) for k in (1, 2))
    return [one, two, np.full(len(start), ref, _U), place[owner], back, back, weight[owner], np.zeros(len(start), np.int8)]


def _emit(pass_: int, buckets: int):
    """Entries of all documents of a task, sent in batches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[list[np.ndarray]] = []
        many = 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                ref = int(row.ref) & ((1 << 64) - 1)
                if pass_ == 1:
                    raw = row.t.encode("utf-8", "surrogatepass")
                    if len(raw) < WIDTH:
                        continue
                    kept.append(_run_entries(raw, ref))
                else:
                    raw = zstandard.decompress(row.z)
                    parts = [p.astype(np.int64) for p in _unpack([row.parts], np.int64, np.int16, np.int16, np.int64)]
                    kept.append((_cell_entries if pass_ == 2 else _window_entries)(raw, ref, parts))
                many += len(kept[-1][0])
                if many > FLUSH:
                    yield from _send(pass_, [np.concatenate(c) for c in zip(*kept)], buckets)
                    kept, many = [], 0
        if kept:
            yield from _send(pass_, [np.concatenate(c) for c in zip(*kept)], buckets)

    return run


def _settle_group(pass_: int):
    """Bring the news to the documents of a group: answers, or what the next pass looks at."""

    def run(docs: pd.DataFrame, news: pd.DataFrame) -> pd.DataFrame:
        _, full, ref, place, lo, hi, _, code = _unpack(news["news"], *_FORM)
        order = np.argsort(ref, kind="stable")
        full, ref, place, lo, hi, code = (x[order] for x in (full, ref, place, lo, hi, code))
        rows = []
        for row in docs.itertuples(index=False):
            own = int(row.ref) & ((1 << 64) - 1)
            mine = slice(np.searchsorted(ref, _U(own)), np.searchsorted(ref, _U(own), "right"))
            raw = zstandard.decompress(row.z)
            windows, parts = None, None
            if pass_ == 1:
                if mine.start < mine.stop:
                    entries = _run_entries(raw, own)
                    windows = np.zeros(len(raw) - WIDTH + 1, bool)
                    # Open and partner news outrank plain ones of the same run.
                    what = dict(zip(full[mine].tolist(), code[mine].tolist()))
                    for f, c in zip(full[mine].tolist(), code[mine].tolist()):
                        what[f] = max(c, what[f])
                    said = np.array([what.get(f, 0) for f in entries[1].tolist()], np.int8)
                    for p, a, b in zip(*(entries[k][said > 0].tolist() for k in (3, 4, 5))):
                        windows[p - b : p - a + 1] = True
                    look = said >= OPEN
                    parts = [entries[k][look] for k in (3, 4, 5)] + [np.where(said[look] == PARTNER, 2, 1)]
            else:
                windows = np.unpackbits(np.frombuffer(zstandard.decompress(row.flags), np.uint8), count=len(raw) - WIDTH + 1).astype(bool)
                for p, a, b, c in zip(*(x[mine].tolist() for x in (place, lo, hi, code))):
                    if c == DEAD:
                        windows[p - b : p - a + 1] = False
                if pass_ == 2:
                    # The batch and the bucket may both have spoken of a cell; it is looked at once.
                    best: dict[tuple[int, int, int], int] = {}
                    for p, a, b, c in zip(*(x[mine].tolist() for x in (place, lo, hi, code))):
                        if c != DEAD:
                            best[p, a, b] = max(best.get((p, a, b), 0), 2 if c == PARTNER else 1)
                    parts = list(np.array([(*k, w) for k, w in sorted(best.items())], np.int64).reshape(-1, 4).T)
            more = parts is not None and len(parts[0])
            if more:
                flags = zstandard.compress(np.packbits(windows).tobytes(), 1)
                packed = _pack(*(p.astype(t) for p, t in zip(parts, (np.int64, np.int16, np.int16, np.int64))))
                rows.append((row.grp, row.ref, row.doc_id, row.n_bytes, row.z, flags, packed, None, None, None))
            else:
                rows.append((row.grp, row.ref, row.doc_id, row.n_bytes, None, None, None, *_answer(raw, windows)))
        names = [c.split()[0] for c in _OUT.split(", ")]
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"n_removed": "Int64", "n_spans": "Int64"})

    return run


def repeated_bytes(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row per row of ``docs``.

    Removes every byte covered by a ``WIDTH``-byte string that also starts elsewhere, in the same
    document or another, judged on the input. A null text is empty, a null id stays, and rows
    that repeat are documents of their own, so each of them repeats the other. Equality is
    that of 128-bit digests.
    """
    spark = prepare(docs.sparkSession)
    thin = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    thin = thin.withColumn("ref", F.xxhash64(F.coalesce("doc_id", F.lit("null")), "t", F.lit(7)))
    total = thin.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    buckets, groups = 16 + total // BUCKET_BYTES, 16 + total // GROUP_BYTES

    def zip_texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw = [t.encode("utf-8", "surrogatepass") for t in frame["t"]]
            grp = (frame["ref"].to_numpy(np.int64).view(_U) % _U(groups)).astype(np.int32)
            z = [zstandard.compress(r, 3) for r in raw]
            yield pd.DataFrame({"grp": grp, "ref": frame["ref"], "doc_id": frame["doc_id"], "n_bytes": [len(r) for r in raw], "z": z, "flags": None, "parts": None})

    now = thin.select("doc_id", "ref", "t").mapInPandas(zip_texts, _DOC)
    out = None
    for pass_ in (1, 2, 3):
        seen = thin.select("ref", "t") if pass_ == 1 else now.select("ref", "z", "parts")
        sent = seen.mapInPandas(_emit(pass_, buckets), "bucket int, blob binary")
        news = sent.groupBy("bucket").applyInPandas(_resolve(pass_, groups), "grp int, news binary")
        told = now.groupBy("grp").cogroup(news.groupBy("grp")).applyInPandas(_settle_group(pass_), _OUT)
        told = settle(told, f"repeats-{pass_}")
        done = told.filter("kept_sha256 is not null").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        out = done if out is None else out.unionAll(done)
        now = told.filter("kept_sha256 is null").drop("n_removed", "n_spans", "kept_sha256")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
