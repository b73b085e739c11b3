"""Whole texts as arrays of code points; helpers for Arrow batches inside tasks.

Texts of a batch are laid end to end, each followed by one space, and worked on by array
operations. A batch is cut into groups of bounded length; a longer text is a group alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

GROUP_CHARS = 400_000  # a group's arrays take some 60 bytes a character
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of each number (finaliser of splitmix64)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _BASE, np.uint64))


def power_table(n: int) -> np.ndarray:
    return powers(1 << max(10, int(n).bit_length()))


def groups(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, texts) so that a group has about GROUP_CHARS characters."""
    start, group, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if group and size + len(text) > GROUP_CHARS:
            yield start, group
            start, group, size = i, [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield start, group


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a space after each, and where each text starts (plus end)."""
    joined = " ".join(texts) + " "
    array = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return array, np.concatenate([[0], np.cumsum(lengths)])


def spans(inside: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; ``cut`` marks places where a run begins anew."""
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    begins = inside & ~before
    if cut is not None:
        begins |= inside & cut
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(before & ~inside)
    if inside.size and inside[-1]:
        stops = np.append(stops, inside.size)
    if cut is None or len(starts) == len(stops):
        return starts, stops
    # A run that was cut ends where the next part starts.
    following = np.append(starts[1:], inside.size)
    nearest = np.searchsorted(stops, starts, "right")
    return starts, np.minimum(following, stops[nearest])


def span_hashes(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's code points."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = stops - starts
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    place = np.arange(total) - np.repeat(first, lengths)
    values = mix64(codes[np.repeat(starts, lengths) + place].astype(np.uint64))
    values *= power_table(int(lengths.max()))[place]
    return mix64(np.add.reduceat(values, first) ^ lengths.astype(np.uint64))


def owners(starts: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Which text each span lies in."""
    return np.searchsorted(text_starts, starts, "right") - 1


def sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values of each owner; values are in order of their owners."""
    out = np.zeros((n, *values.shape[1:]), values.dtype)
    if len(values):
        firsts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        out[owner[firsts]] = np.add.reduceat(values, firsts, axis=0)
    return out


@cache
def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@cache
def word_table() -> np.ndarray:
    """For each code point, whether it is a letter or a digit."""
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


@cache
def space_table() -> np.ndarray:
    return np.fromiter((chr(i).isspace() for i in range(0x110000)), bool, 0x110000)
