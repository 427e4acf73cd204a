"""Vectorised word hashes: every word of a batch of texts as 64 bits, with few passes over the bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

U = np.uint64
#: Bytes with A-Z in lower case, and which bytes part words.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: Characters of texts hashed at once; words of more bytes are hashed one by one.
CHUNK, LONG = 2_000_000, 200


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with about CHUNK characters each, and where they begin."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= CHUNK or i + 1 == len(texts):
            yield begin, [t or "" for t in texts[begin : i + 1]]
            begin, held = i + 1, 0


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's begin (one more than texts)."""
    raw = [t.encode("utf-8", "surrogatepass").translate(LOWER) for t in texts]
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    white = np.flatnonzero(WHITE[buf])
    start = np.concatenate((np.zeros(1, np.int64), white[:-1] + 1))
    length = white - start
    start, length = start[length > 0], length[length > 0]
    order = np.argsort(-length, kind="stable")
    start_by, length_by = start[order], length[order]
    falling = -length_by
    hashed = np.full(len(order), U(0x9E3779B97F4A7C15))
    long = int(np.searchsorted(falling, -LONG))
    for i in range(min(LONG, int(length_by[0])) if len(order) else 0):
        n = int(np.searchsorted(falling, -i))
        x = hashed[:n]
        x ^= buf[start_by[:n] + i]
        x *= U(0x100000001B3)
        x ^= x >> U(29)
    for k in range(long):
        word = buf[start_by[k] : start_by[k] + length_by[k]].tobytes()
        hashed[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    out = np.empty_like(hashed)
    out[order] = mix(hashed + length_by.astype(U))
    ends = np.cumsum([len(x) + 1 for x in raw])
    return out, np.concatenate((np.zeros(1, np.int64), np.searchsorted(start, ends)))


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Each text's set of hashed runs of `size` words, sorted; of the whole text if it has fewer words."""
    words, at = word_hashes(texts)
    runs = np.zeros(max(0, len(words) - size + 1), U)
    for k in range(size):
        runs = mix(runs * U(0x9DDFEA08EB382D69) + words[k : k + len(runs)])
    out = []
    for i in range(len(texts)):
        a, b = at[i], at[i + 1]
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            short = np.full(1, U(b - a))
            for w in words[a:b]:
                short = mix(short * U(0x9DDFEA08EB382D69) + w)
            out.append(short)
        else:
            out.append(np.zeros(0, U))
    return out
