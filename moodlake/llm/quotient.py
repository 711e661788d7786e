"""Counting quotient filters over packed word-id n-grams.

An n-gram of word ids is packed into two halves and permuted by a keyed Feistel network, which
can be inverted, so the permuted value stands for the n-gram itself: no two n-grams meet. The
top bits of the permuted value deal the filter into ranges, the next are the quotient, all that
is left is the remainder, kept in full. Entries lie sorted; the quotients are written as one
bit vector (a zero closes a quotient, a one is an entry), remainders in as many bytes as they
need, counters in one byte with the few larger ones listed beside. Nothing is approximate.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_KEYS = [_U(k) for k in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
MAX_ID_BITS = 32


def _mix(h: np.ndarray, key: np.uint64) -> np.ndarray:
    h = (h + key) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(29))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(32))


def _low(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


class Layout:
    """Widths of the halves of packed ``n``-grams (2 to 4 words) with ids of ``bits`` bits."""

    def __init__(self, n: int, bits: int):
        if not 2 <= n <= 4 or not 1 <= bits <= MAX_ID_BITS:
            raise ValueError(f"no layout for {n} ids of {bits} bits")
        self.n, self.bits = n, bits
        self.left, self.right = (bits, bits) if n == 2 else (2 * bits, bits) if n == 3 else (2 * bits, 2 * bits)
        self.narrow = self.left + self.right <= 64

    def pack(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Halves of the n-grams, ``words[k]`` being the ids at place ``k``."""
        b, w = _U(self.bits), [x.astype(_U) for x in words]
        return (w[0] if self.n == 2 else w[0] << b | w[1]), (w[-1] if self.n < 4 else w[2] << b | w[3])

    def unpack(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        b, m = _U(self.bits), _low(self.bits)
        heads = [left] if self.n == 2 else [left >> b, left & m]
        return [x.astype(np.int64) for x in [*heads, *([right] if self.n < 4 else [right >> b, right & m])]]

    def permute(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in (0, 2):
            left = left ^ (_mix(right, _KEYS[k]) & _low(self.left))
            right = right ^ (_mix(left, _KEYS[k + 1]) & _low(self.right))
        return left, right

    def restore(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in (2, 0):
            right = right ^ (_mix(left, _KEYS[k + 1]) & _low(self.right))
            left = left ^ (_mix(right, _KEYS[k]) & _low(self.left))
        return left, right

    def order(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if self.narrow:
            return np.argsort(left << _U(self.right) | right, kind="stable")
        return np.lexsort((right, left))

    def count(self, left: np.ndarray, right: np.ndarray, times: np.ndarray | None = None):
        """Sorted distinct values, their counts, and the place of every value among them."""
        if not len(left):
            return left, right, np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = self.order(left, right)
        left, right = left[order], right[order]
        new = np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
        first = np.flatnonzero(new)
        if times is None:
            counts = np.diff(np.append(first, len(left)))
        else:
            counts = np.add.reduceat(times[order], first)
        place = np.empty(len(left), np.int64)
        place[order] = np.cumsum(new) - 1
        return left[first], right[first], counts.astype(np.int64), place

    def ranges(self, left: np.ndarray, parts: int) -> np.ndarray:
        """The range of each value; ranges follow the order of the values."""
        top = min(self.left, 32)
        return ((left >> _U(self.left - top)) * _U(parts) >> _U(top)).astype(np.int64)

    def _split(self, entries: int) -> int:
        """Low bits of the left half that are remainder: about one quotient for each entry."""
        return max(0, self.left - max(1, int(entries).bit_length()))

    def write(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray, parts: int) -> bytes:
        """One range of a filter, its entries sorted."""
        n = len(left)
        # A range holds 1 / parts of the values, so its quotients start at its first one.
        low = self._split(n * parts)
        quotient = left >> _U(low)
        base = int(quotient[0])
        at = (quotient - _U(base)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 1, np.uint8)
        bits[at] = 1
        big = np.flatnonzero(counts >= 255)
        head = np.array([n, parts, base, len(bits), len(big)], "<u8").tobytes()
        rest = [_bytes(left & _low(low), low), _bytes(right, self.right)]
        tail = np.concatenate([big, counts[big]]).astype("<u8").tobytes()
        return b"".join([head, np.packbits(bits).tobytes(), *rest, np.minimum(counts, 255).astype(np.uint8).tobytes(), tail])

    def read(self, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, parts, base, size, big = np.frombuffer(blob, "<u8", 5).tolist()
        low, at = self._split(n * parts), 40
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, -(-size // 8), at), count=size))
        at += -(-size // 8)
        rest = []
        for bits in (low, self.right):
            width = -(-bits // 8)
            rest.append(_value(np.frombuffer(blob, np.uint8, n * width, at).reshape(n, width)))
            at += n * width
        counts = np.frombuffer(blob, np.uint8, n, at).astype(np.int64)
        more = np.frombuffer(blob, "<u8", 2 * big, at + n).astype(np.int64)
        counts[more[:big]] = more[big:]
        quotient = (ones - np.arange(n)).astype(_U) + _U(base)
        return quotient << _U(low) | rest[0], rest[1], counts


def _bytes(values: np.ndarray, bits: int) -> bytes:
    width = -(-bits // 8)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _value(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, : raw.shape[1]] = raw
    return wide.view("<u8").reshape(-1)
