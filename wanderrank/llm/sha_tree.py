"""SHA-256 over many rows at once, with states that can be kept and resumed.

A state is the eight 32-bit words after some whole 64-byte blocks. Digests enter
as lowercase hex, so each is exactly one block and a state between two digests
has no bytes left over: it is a 32-byte value that can be copied, stored in a
table and resumed elsewhere. ``hashlib`` has ``copy()`` too, but its objects do
not leave a process. The constants follow their definition (fractional parts of
square and cube roots of the first primes).
"""

from __future__ import annotations

import math

import numpy as np

_U = np.uint32


def _primes(n: int) -> list[int]:
    out: list[int] = []
    k = 2
    while len(out) < n:
        if all(k % p for p in out):
            out.append(k)
        k += 1
    return out


def _cube_root(x: int) -> int:
    lo, hi = 0, 1 << (x.bit_length() // 3 + 1)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if mid ** 3 <= x else (lo, mid - 1)
    return lo


START = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], dtype=_U)
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], dtype=_U)
_HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def _turn(x: np.ndarray, k: int) -> np.ndarray:
    return (x >> _U(k)) | (x << _U(32 - k))


def _compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """state (8, n), block (16, n) -> state after the block."""
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> _U(3))) + w[i - 7]
                     + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> _U(10))))
        t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[i] + w[i]
        u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        h, g, f, e, d, c, b, a = g, f, e, d + t, c, b, a, t + u
    return state + np.stack([a, b, c, d, e, f, g, h])


CHUNK = 4_096  # rows whose words stay in the processor's cache


def _blocks(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    out = np.empty_like(state)
    for at in range(0, state.shape[1], CHUNK):
        s = slice(at, at + CHUNK)
        out[:, s] = _compress(state[:, s], block[:, s])
    return out


def starts(n: int) -> np.ndarray:
    """(n, 8): states before any block."""
    return np.repeat(START[None, :], n, axis=0)


def absorb(state: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """States (n, 8) after the hex texts of ``digest`` (n, 8)."""
    raw = np.ascontiguousarray(digest.astype(">u4")).view(np.uint8).reshape(len(digest), 32)
    text = np.empty((len(digest), 64), dtype=np.uint8)
    text[:, 0::2], text[:, 1::2] = _HEX[raw >> 4], _HEX[raw & 15]
    words = text.view(">u4").astype(_U)
    return _blocks(np.ascontiguousarray(state.T), np.ascontiguousarray(words.T)).T


def finish(state: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 8) of messages of ``n_blocks`` whole blocks."""
    pad = np.zeros((16, len(state)), dtype=_U)
    pad[0] = 0x80000000
    bits = n_blocks.astype(np.uint64) * np.uint64(512)
    pad[14], pad[15] = (bits >> np.uint64(32)).astype(_U), bits.astype(_U)
    return _blocks(np.ascontiguousarray(state.T), pad).T


def to_bytes(words: np.ndarray) -> list[bytes]:
    raw = np.ascontiguousarray(words.astype(">u4")).tobytes()
    return [raw[i:i + 32] for i in range(0, len(raw), 32)]


def from_bytes(raw: bytes) -> np.ndarray:
    """(n, 8) from n * 32 bytes."""
    return np.frombuffer(raw, dtype=">u4").astype(_U).reshape(-1, 8)


# ----------------------------------------------------------------- whole levels
class Level:
    """One level of a forest: nodes in order, with the copied state before each
    child's slot, and the parents above them."""

    def __init__(self, tree: np.ndarray, at: np.ndarray, digest: np.ndarray, grows: np.ndarray, fanout: int):
        """``at``: position of a node inside its tree; nodes whose ``grows`` is
        false have no parent and stand for themselves on the level above."""
        self.digest, self.grows = digest, grows
        slot = np.where(grows, at % fanout, 0)
        first = np.r_[True, (tree[1:] != tree[:-1]) | (at[1:] // fanout != at[:-1] // fanout)] | ~grows
        self.parent = np.cumsum(first) - 1
        self.first = np.flatnonzero(first)
        self.slot = slot
        self.count = np.diff(np.r_[self.first, len(at)])
        states = starts(len(self.first))
        self.state = np.empty_like(digest)
        for s in range(min(fanout, int(self.count.max(initial=1)))):
            here = np.flatnonzero(slot == s)
            up = self.parent[here]
            self.state[here] = states[up]
            states[up] = absorb(states[up], digest[here])
        kept = ~grows[self.first]
        self.above = finish(states, self.count)
        self.above[kept] = digest[self.first[kept]]
        self.tree, self.at = tree[self.first], np.where(kept, at[self.first], at[self.first] // fanout)

    def fold(self, node: np.ndarray, digest: np.ndarray) -> np.ndarray:
        """Digests of the parents of ``node`` with ``digest`` in its place: the
        state before the slot, the replacement, then the siblings on the right."""
        up, out = self.parent[node], digest.copy()
        live = np.flatnonzero(self.grows[node])
        state = absorb(self.state[node[live]], digest[live])
        for k in range(1, int(self.count.max(initial=1))):
            more = np.flatnonzero(self.slot[node[live]] + k < self.count[up[live]])
            if len(more):
                state[more] = absorb(state[more], self.digest[node[live[more]] + k])
        out[live] = finish(state, self.count[up[live]])
        return out

    def siblings(self, node: np.ndarray):
        """Yield (rows, digests) of the other children of each parent, left to right."""
        up = self.parent[node]
        for s in range(int(self.count.max(initial=1))):
            rows = np.flatnonzero(self.grows[node] & (s < self.count[up]) & (s != self.slot[node]))
            if len(rows):
                yield rows, self.digest[self.first[up[rows]] + s]
