"""Lists of many terms: one pass over a text however long the list is.

The terms become an Aho-Corasick automaton in arrays: a table from state and sign to the next
state, and the term that ends in a state. Texts are cut into windows that overlap by the longest
term, and some thousand windows move through the table together.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.functions.text import url_host

WINDOW = 1024
# Windows that move together, and ends of terms that are held before equal ones are merged.
WINDOWS = 4096
HITS = 1 << 19
# Cells of a table; a longer list gets several automata, each run over the texts.
TABLE_CELLS = 1 << 24


class Automaton:
    """Terms (bytes, not empty) as a table of states."""

    def __init__(self, terms: list[bytes]):
        signs = sorted({b for t in terms for b in t})
        # Signs that no term has share class 0, which leads back to the start.
        self.classes = np.zeros(256, np.uint8 if len(signs) < 256 else np.int16)
        self.classes[signs] = np.arange(1, len(signs) + 1)
        self.longest = max(map(len, terms))
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for number, term in enumerate(terms):
            at = 0
            for b in term:
                c = int(self.classes[b])
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    ends.append(-1)
                at = children[at][c]
            ends[at] = number
        self.table = np.zeros((len(children), len(signs) + 1), np.int32)
        # The nearest shorter state that ends a term: all terms ending in a place are on this chain.
        self.chain = np.zeros(len(children), np.int32)
        self.ends = np.array(ends, np.int32)
        fail = [0] * len(children)
        waiting = deque([0])
        while waiting:
            at = waiting.popleft()
            if at:
                self.table[at] = self.table[fail[at]]
            for c, child in children[at].items():
                fail[child] = int(self.table[fail[at], c]) if at else 0
                self.table[at, c] = child
                waiting.append(child)
            if at:
                self.chain[at] = fail[at] if ends[fail[at]] >= 0 else self.chain[fail[at]]
        self.hit = (self.ends >= 0) | (self.chain > 0)
        self.terms = len(terms)

    def _windows(self, texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """Text numbers and windows, in order, of at most ``WINDOWS`` windows at a time."""
        step, over = WINDOW, self.longest - 1
        owner, parts = [], []
        for k, t in enumerate(texts):
            for at in range(0, max(1, len(t) - over), step):
                owner.append(k)
                parts.append(t[at : at + step + over])
                if len(parts) == WINDOWS:
                    yield np.array(owner), parts
                    owner, parts = [], []
        if parts:
            yield np.array(owner), parts

    def _find(self, who: np.ndarray, parts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Text numbers and states wherever a term ends in the windows; a place may come twice."""
        order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
        some, who = [parts[i] for i in order], who[order]
        size = np.array([len(s) for s in some])
        width = int(size[0])
        grid = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in some), np.uint8).reshape(len(some), width)
        signs = np.ascontiguousarray(self.classes[grid].T)
        state = np.zeros(len(some), np.int32)
        live = np.searchsorted(-size, -np.arange(width), side="left")
        for j in range(width):
            n = live[j]
            state[:n] = self.table[state[:n], signs[j, :n]]
            hot = np.flatnonzero(self.hit[state[:n]])
            if len(hot):
                yield who[hot], state[hot]

    def find(self, texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Text numbers and states wherever a term ends; a place may come twice."""
        for who, parts in self._windows(texts):
            yield from self._find(who, parts)

    def any(self, texts: Iterable[bytes], n: int | None = None) -> np.ndarray:
        """Does each of the ``n`` texts (their length, if they have one) hold a term?"""
        out = np.zeros(len(texts) if n is None else n, bool)
        for who, _ in self.find(texts):
            out[who] = True
        return out

    def _ended(self, codes: np.ndarray) -> np.ndarray:
        """``text * terms + term``, distinct and ascending, of distinct ``text * states + state``."""
        who, at = np.divmod(codes, len(self.ends))
        out = []
        while len(at):
            ended = self.ends[at] >= 0
            out.append(who[ended] * self.terms + self.ends[at][ended])
            more = self.chain[at] > 0
            who, at = who[more], self.chain[at][more]
        return np.unique(np.concatenate([np.zeros(0, np.int64), *out]))

    def held(self, texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Text numbers and the numbers of the terms in them, some texts at a time.

        A pair comes once for each block of windows, so that a long text may have it again. What is held
        at once is bounded by the windows of a block, whatever the texts.
        """
        for who, parts in self._windows(texts):
            seen, waiting, n = np.zeros(0, np.int64), [], 0
            for of, states in self._find(who, parts):
                waiting.append(of.astype(np.int64) * len(self.ends) + states)
                n += len(states)
                if n > HITS:
                    seen, waiting, n = np.unique(np.concatenate([seen, *waiting])), [], 0
            yield np.divmod(self._ended(np.unique(np.concatenate([seen, *waiting]))), self.terms)

    def which(self, texts: list[bytes]) -> list[set[int]]:
        """The numbers of the terms in each text."""
        out: list[set[int]] = [set() for _ in texts]
        for who, found in self.held(texts):
            for k, term in zip(who.tolist(), found.tolist()):
                out[k].add(term)
        return out


def _automata(terms: Iterable[str], ignore_case: bool) -> list[tuple[list[int], list[bytes]]]:
    """Numbers and bytes of the terms, in lists whose tables are of bounded size."""
    lists, cells, seen = [([], [])], 0, set()
    for number, term in enumerate(terms):
        raw = (term.lower() if ignore_case else term).encode("utf-8", "surrogatepass")
        if not raw or raw in seen:
            continue
        seen.add(raw)
        # A state a byte at most, and as many columns as there are signs.
        if cells + len(raw) * 256 > TABLE_CELLS and lists[-1][0]:
            lists.append(([], []))
            cells = 0
        lists[-1][0].append(number)
        lists[-1][1].append(raw)
        cells += len(raw) * 256
    return [x for x in lists if x[0]]


_built: dict[tuple, Automaton] = {}


def _automaton(raw: tuple[bytes, ...]) -> Automaton:
    if raw not in _built:
        if len(_built) > 8:
            _built.clear()
        _built[raw] = Automaton(list(raw))
    return _built[raw]


def _bytes(texts: pd.Series) -> Iterator[bytes]:
    return (t.encode("utf-8", "surrogatepass") for t in texts)


def holds_term(c: Column | str, terms: Iterable[str], ignore_case: bool = True) -> Column:
    """Does the text hold any of the terms, as ``contains_any`` does, for lists of any length?
    Null is false. Case is that of Spark's ``lower`` on the text and of the terms lower-cased."""
    lists = [tuple(raw) for _, raw in _automata(terms, ignore_case)]
    text = F.col(c) if isinstance(c, str) else c

    @F.pandas_udf("boolean")
    def hit(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), bool)
        for of in lists:
            left = np.flatnonzero(~out)
            out[left] = _automaton(of).any(_bytes(texts.iloc[left]), len(left))
        return pd.Series(out)

    return hit(F.coalesce(F.lower(text) if ignore_case else text, F.lit(""))) if lists else F.lit(False)


def terms_in(c: Column | str, terms: Iterable[str], ignore_case: bool = True) -> Column:
    """The numbers (from 0) of the terms that the text holds, ascending; of equal terms the first.
    Null gives an empty array."""
    lists = [(numbers, tuple(raw)) for numbers, raw in _automata(terms, ignore_case)]
    text = F.col(c) if isinstance(c, str) else c
    if not lists:
        return F.array().cast("array<int>")

    @F.pandas_udf("array<int>")
    def find(texts: pd.Series) -> pd.Series:
        out = [np.zeros(0, np.int32)] * len(texts)
        for numbers, of in lists:
            of_list = np.array(numbers, np.int32)
            for who, terms in _automaton(of).held(_bytes(texts)):
                first = np.flatnonzero(np.diff(who, prepend=-1))
                for k, found in zip(who[first].tolist(), np.split(of_list[terms], first[1:])):
                    out[k] = np.union1d(out[k], found) if len(out[k]) else np.sort(found)
        return pd.Series(out)

    return find(F.coalesce(F.lower(text) if ignore_case else text, F.lit("")))


def on_hosts(url: Column | str, hosts: Iterable[str]) -> Column:
    """Is the URL on one of the hosts or a subdomain of one? Null is false.

    The listed hosts form a trie of their labels from the right, and a URL's host is walked
    down it label by label, once for each distinct host of a batch.
    """
    trie: dict = {}
    for host in hosts:
        at = trie
        labels = [x for x in host.lower().split(".") if x]
        for label in reversed(labels):
            at = at.setdefault(label, {})
        if labels:
            at[""] = {}

    def listed(host: str | None) -> bool:
        at = trie
        for label in reversed(host.split(".") if host else ()):
            at = at.get(label)
            if at is None:
                return False
            if "" in at:
                return True
        return False

    @F.pandas_udf("boolean")
    def walk(found: pd.Series) -> pd.Series:
        return found.map({h: listed(h) for h in found.dropna().unique()}).fillna(False).astype(bool)

    return walk(url_host(url))


def of_hosts(df: DataFrame, url: str, hosts: DataFrame, host: str = "host") -> DataFrame:
    """Rows whose URL is on one of the hosts or a subdomain of one, for lists held in a table.

    Only distinct hosts are shuffled, each with its handful of parents; rows meet the hosts
    found by a semi-join.
    """
    name = url_host(url)
    listed = hosts.select(F.lower(F.col(host)).alias("_parent")).distinct()
    parts = F.split("_host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    own = df.select(name.alias("_host")).filter("_host is not null").distinct()
    found = own.select("_host", F.explode(parents).alias("_parent")).join(listed, "_parent", "left_semi").select("_host").distinct()
    return df.join(found, name == F.col("_host"), "left_semi")
