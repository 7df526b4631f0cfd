"""SHA-256 over whole arrays of messages, with its states in the open.

``hashlib`` can copy a state but not store one; here a state is eight words, kept as 32 bytes, so a table
can hold it and another task can go on from it.  A node's digest enters its parent as 64 hexadecimal
characters, which is exactly one block of SHA-256: the state before a child slot has no unfinished block.
"""

from __future__ import annotations

import numpy as np


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _root_bits(p: int, degree: int) -> int:
    """The first 32 bits of the fractional part of a prime's square or cube root (how SHA-256 is defined)."""
    scaled = p << (32 * degree)
    low, high = 0, 1 << 40
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid ** degree <= scaled else (low, mid - 1)
    return low & 0xFFFFFFFF


START = np.array([_root_bits(p, 2) for p in _primes(8)], np.uint32)
ROUND = np.array([_root_bits(p, 3) for p in _primes(64)], np.uint32)
HEX = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), np.uint8).reshape(256, 2)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n, 32 bytes) after one more block each (n, 64 bytes)."""
    w = list(np.ascontiguousarray(blocks.view(">u4").T).astype(np.uint32))
    first = list(np.ascontiguousarray(states.view(">u4").T).astype(np.uint32))
    a, b, c, d, e, f, g, h = first
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[i - 7]
                     + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        t1 = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + ROUND[i] + w[i]
        t2 = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t1 + t2, a, b, c, d + t1, e, f, g
    out = np.stack([x + y for x, y in zip(first, (a, b, c, d, e, f, g, h))], axis=1)
    return np.ascontiguousarray(out.astype(">u4")).view(np.uint8).reshape(-1, 32)


def fresh(n: int) -> np.ndarray:
    """n states in which nothing was hashed yet."""
    return np.tile(START.astype(">u4").view(np.uint8), (n, 1))


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32) as the blocks of their hexadecimal text (n, 64)."""
    return HEX[digests].reshape(-1, 64)


def finish(states: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """Digests of messages of n_blocks whole blocks, from the states after them."""
    last = np.zeros((len(states), 64), np.uint8)
    last[:, 0] = 0x80
    last[:, 56:] = (n_blocks.astype(np.uint64) * np.uint64(512)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return compress(states, last)
