"""Hashed word counts of a text, for the vectorised functions that need them in a worker."""

from __future__ import annotations

import re
from collections.abc import Sequence
from hashlib import md5
from itertools import chain

import numpy as np

_WORD = re.compile(r"\w{2,}")
_MEMO_WORDS = 500_000
_places: dict[str, int] = {}


def _hash(word: str) -> int:
    found = _places.get(word)
    if found is None:
        if len(_places) > _MEMO_WORDS:
            _places.clear()
        found = _places[word] = int.from_bytes(md5(word.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()[:4], "big")
    return found


def unit_counts(text: str, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending) and weights of the unit vector of a lower-cased text's word counts.

    A word is a run of two or more letters, digits and underscores; its place is its MD5 modulo
    ``dims``. A distinct word is hashed once a worker.
    """
    hashes = np.fromiter(map(_hash, _WORD.findall(text)), np.int64)
    at, n = np.unique(hashes % dims, return_counts=True)
    return at.astype(np.int32), n / np.sqrt(np.maximum((n.astype(float) ** 2).sum(), 1))


def unit_rows(texts: Sequence[str], dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``unit_counts`` of many texts at once: the number of places of each, all places, all weights."""
    words = [_WORD.findall(t) for t in texts]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    hashes = np.fromiter(map(_hash, chain.from_iterable(words)), np.int64, n_words.sum())
    codes, n = np.unique(np.repeat(np.arange(len(words)), n_words) * dims + hashes % dims, return_counts=True)
    row, at = np.divmod(codes, dims)
    length = np.sqrt(np.maximum(np.bincount(row, n.astype(float) ** 2, len(words)), 1))
    return np.bincount(row, minlength=len(words)), at.astype(np.int32), n / length[row]
