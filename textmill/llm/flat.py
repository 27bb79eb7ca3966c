"""Texts as one flat array of code points or bytes, for vectorised passes over many texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_POINTS = 1 << 20
#: Words hashed at a time; longer words (in bytes) are hashed one by one.
HASHED_WORDS, LONG_WORD = 1 << 14, 64
FACTOR = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(LONG_WORD, FACTOR))


def pieces(texts: list[str], limit: int = SLICE_POINTS, shared: int = 0) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Slices of bounded size: the texts' numbers and the texts, a longer text in several pieces cut at white space, each with the last ``shared`` characters of the one before."""
    numbers, held, size = [], [], 0
    for i, text in enumerate(texts):
        begin = 0
        while True:
            end = len(text)
            if end - begin > limit:
                end = max((text.rfind(c, begin + shared, begin + limit) for c in " \n"), default=-1)
                end = begin + limit if end <= begin + shared else end
            numbers.append(i)
            held.append(text[begin:end])
            size += end - begin
            if size >= limit:
                yield np.array(numbers), held
                numbers, held, size = [], [], 0
            if end >= len(text):
                break
            begin = end - shared
    if held:
        yield np.array(numbers), held


def points(texts: list[str], before: str, after: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each between ``before`` and ``after``, and the text number of each point."""
    padded = [before + t + after for t in texts]
    flat = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return flat, np.repeat(np.arange(len(padded)), [len(p) for p in padded])


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers whose upper bits depend on all bits given."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits for every binary value that depend on its bytes only."""
    hashed = np.empty(len(words), dtype=np.uint64)
    for at in range(0, len(words), HASHED_WORDS):
        part = words.slice(at, HASHED_WORDS).cast(pa.large_binary())
        lengths = np.asarray(pc.binary_length(part), dtype=np.int64)
        long = lengths > LONG_WORD
        short = pc.if_else(pa.array(long), pa.scalar(b"", pa.large_binary()), part)
        sizes = np.where(long, 0, lengths)
        ends = np.cumsum(sizes)
        letters = np.frombuffer(short.buffers()[2] or b"", dtype=np.uint8)[: int(ends[-1])]
        inside = np.arange(len(letters)) - np.repeat(ends - sizes, sizes)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((letters + np.uint64(1)) * _POWERS[inside])])
        found = sums[ends] - sums[ends - sizes]
        for i in np.flatnonzero(long):
            found[i] = int.from_bytes(hashlib.blake2b(part[int(i)].as_py(), digest_size=8).digest(), "little")
        hashed[at : at + len(part)] = mixed(found + lengths.astype(np.uint64))
    return hashed
