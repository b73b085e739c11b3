"""Periodic runs of words, found by seeds on diagonals and their extension.

A run is a stretch of words that repeats with a smallest period q and is at least three
periods and ``least`` words long. At lag q its words agree with themselves over at least
max(least - q, 2 q) words, so every run of a period up to 16 (at ``least`` = 24) holds two
equal 16-grams q words apart. That is the minimum guaranteed overlap: all 16-grams of a
document are indexed. Longer periods are looked for with grams of 32, 64, ... words, each
for the periods up to its own length, which the overlap of two periods guarantees as well.

A gram that covers a whole smallest period cannot occur in between, so a seed is an
occurrence of a gram and the *next* one in the same document: as many seeds as words at most,
also where one word is repeated throughout. A seed is extended along its diagonal (lag) as far
as words agree; a table of the furthest place covered on each lag keeps later seeds of the
same stretch from being extended again.

Grams are named by numbers, doubled in length step by step from exactly numbered words; a
gram that does not recur in its document cannot be part of a longer one that does, so few
places are left after the first steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.tables import map_texts
from haulmark.llm.text import codes, groups, span_hashes, spans

WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_BLOCK = 256  # words compared at first when a seed is extended; doubled each time


@dataclass(frozen=True)
class RunConfig:
    least: int = 24  # words of a run
    periods: int = 3  # that a run holds at least

    def __post_init__(self) -> None:
        if self.periods < 3 or self.least < 2:
            raise ValueError("a run holds three periods or more, of two words or more")

    @property
    def seed(self) -> int:
        """The largest power of two that every overlap is guaranteed to reach."""
        overlap = min(
            max(self.least - q, (self.periods - 1) * q) for q in range(1, self.least + 1)
        )
        return 1 << (max(1, overlap).bit_length() - 1)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points, starts and stops of the words of all texts, and each text's first word
    (plus the end)."""
    points, text_starts = codes(texts)
    white = (points == 32) | ((points >= 9) & (points <= 13))
    starts, stops = spans(~white)
    return points, starts, stops, np.searchsorted(starts, text_starts)


def word_numbers(points: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A number for each word, equal exactly where the words are.

    Words are told apart by a hash; each is then compared with the first word of its hash,
    so that a collision is seen, and all are numbered by themselves in that case.
    """
    hashed = span_hashes(points, starts, stops)
    _, first, number = np.unique(hashed, return_index=True, return_inverse=True)
    lengths = stops - starts
    model = first[number]
    same = bool((lengths == lengths[model]).all())
    if same and len(starts):
        place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        own = points[np.repeat(starts, lengths) + place]
        same = bool((own == points[np.repeat(starts[model], lengths) + place]).all())
    if same:
        return number
    known: dict[bytes, int] = {}
    return np.array(
        [known.setdefault(points[a:b].tobytes(), len(known)) for a, b in zip(starts, stops, strict=True)],
        np.int64,
    )


def _recurring(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs more than once, ordered by (key, place), and names of keys."""
    if not len(key):
        return place, key
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    name = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1
    shared = np.bincount(name) > 1
    kept = shared[name]
    return place[kept], (np.cumsum(shared) - 1)[name[kept]]


def extend(number: np.ndarray, first: int, stop: int, i: int, lag: int) -> tuple[int, int]:
    """The widest stretch [a, b) around place i in which words agree with those ``lag`` on,
    all within the words first to stop of one document."""
    a, b, step = i, i, _BLOCK
    while b + lag < stop:
        end = min(b + step, stop - lag)
        differs = number[b:end] != number[b + lag : end + lag]
        if differs.any():
            b += int(differs.argmax())
            break
        b, step = end, step * 2
    step = _BLOCK
    while a > first:
        start = max(first, a - step)
        differs = number[start:a] != number[start + lag : a + lag]
        if differs.any():
            a -= int(differs[::-1].argmax())
            break
        a, step = start, step * 2
    return a, b


def find_runs(
    number: np.ndarray, bounds: np.ndarray, config: RunConfig = RunConfig()
) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each document, by start, then period.

    ``number`` names the words of all documents, end to end; ``bounds`` are where each
    document begins (plus the end).
    """
    found: list[list[tuple[int, int, int]]] = [[] for _ in bounds[:-1]]
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if not len(number):
        return found
    width = int(number.max()) + 1
    # One word: numbers that recur in a document long enough for a run.
    wanted = np.flatnonzero(sizes[owner] >= config.least)
    place, name = _recurring(owner[wanted] * width + number[wanted], wanted)
    length = 1
    covered: dict[int, int] = {}  # by lag; places ascend, and each lag has one gram length
    while len(place):
        if length >= config.seed:
            lag = place[1:] - place[:-1]
            seeds = (name[1:] == name[:-1]) & (lag <= length)
            if length > config.seed:  # shorter lags were looked at with shorter grams
                seeds &= lag > length // 2
            at, lag = place[:-1][seeds], lag[seeds]
            order = np.lexsort((at, lag))
            at, lag = at[order], lag[order]
            # The next seed on the same lag is covered by the one before it.
            head = np.append(True, (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1]))[: len(at)]
            for i, q in zip(at[head].tolist(), lag[head].tolist(), strict=True):
                if i < covered.get(q, -1):
                    continue
                doc = int(owner[i])
                first, stop = int(bounds[doc]), int(bounds[doc + 1])
                a, b = extend(number, first, stop, i, q)
                covered[q] = b
                if b - a + q >= max(config.least, config.periods * q):
                    found[doc].append((a - first, b - a + q, q))
        # Grams of twice the length: two that follow each other, both recurring.
        names = np.full(len(number) + length, -1, np.int64)
        names[place] = name
        left = place[names[place + length] >= 0]
        key = names[left] * (int(name.max()) + 1) + names[left + length]
        place, name = _recurring(key, left)
        length *= 2
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def repeated(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of the n words a run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:-1] > 0


def collapsed(text: str, starts: np.ndarray, stops: np.ndarray, runs: list) -> str:
    """The words left when those that only repeat are dropped, joined by one space."""
    kept = ~repeated(len(starts), runs)
    return " ".join([text[a:b] for a, b in zip(starts[kept].tolist(), stops[kept].tolist(), strict=True)])


def periodic_runs(
    docs: DataFrame, keep: list[str], config: RunConfig = RunConfig()
) -> DataFrame:
    """``keep`` columns, n_words, runs and collapsed (text without repetitions) of every row.

    ``runs`` are structs (start, length, period) in words from 0, by start, then period. A
    null text counts as empty: no words, no runs, an empty collapsed text. Whole texts of any
    length are read, each by itself, so repeated rows give equal rows; an empty table gives no
    rows. Names that a kept column has get underscores appended. There is no shuffle.
    """
    kind = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def work(texts: list[str | None]) -> Iterator[tuple[int, int, list[pa.Array]]]:
        for start, group in groups(texts):
            points, starts, stops, bounds = words(group)
            number = word_numbers(points, starts, stops)
            found = find_runs(number, bounds, config)
            text_starts = np.cumsum([0] + [len(t) + 1 for t in group])
            plain = []
            for i, (text, runs) in enumerate(zip(group, found, strict=True)):
                own = slice(bounds[i], bounds[i + 1])
                plain.append(
                    collapsed(text, starts[own] - text_starts[i], stops[own] - text_starts[i], runs)
                )
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            offsets = np.cumsum([0] + [len(runs) for runs in found]).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields=list(kind))
            yield start, len(group), [
                pa.array(np.diff(bounds).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), structs),
                pa.array(plain, pa.string()),
            ]

    return map_texts(
        docs, keep, {"n_words": "bigint", "runs": RUNS, "collapsed": "string"}, work
    )


# ---- the registered query ---------------------------------------------------------------


def planted(text: Column, doc_id: Column) -> Column:
    """The text, in a tenth of the documents with a tail that repeats its own beginning.

    With h the CRC-32 of the id in decimal: where h ends in 0, each word from a on becomes
    word a + (i - a) % p. A null id leaves the text as it is.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    found = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    n = F.nullif(F.size(found), F.lit(0))
    a = (g % n).cast("int")
    p = F.lit(1) + F.floor((n - a) / (g % 8 + 3)).cast("int")
    unit = F.slice(found, a + 1, p)
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, times)), 1, n - a)
    changed = F.concat(F.slice(found, 1, a), tail)
    whole = F.when(n > 0, F.array_join(changed, " ")).otherwise(text)
    return F.when((h % 10 == 0) & text.isNotNull(), whole).otherwise(text)


def digest(found: DataFrame, runs: str = "runs", plain: str = "collapsed") -> dict[str, Column]:
    """n_runs, the run of the greatest exponent, and hashes of all runs and the plain text."""
    r = F.col(runs)
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")

    def better(best: Column, run: Column) -> Column:
        greater = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | greater, run).otherwise(best)

    best = F.reduce(r, none, better)
    line = F.transform(
        r, lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))
    )
    return {
        "n_runs": F.size(r).cast("bigint"),
        "start": best["start"],
        "length": best["length"],
        "period": best["period"],
        "exponent_milli": F.floor(best["length"] * 1000 / best["period"]).cast("bigint"),
        "runs_sha256": F.sha2(F.array_join(line, ""), 256),
        "collapsed_sha256": F.sha2(F.col(plain), 256),
    }


def run_report(docs: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """The query's rows: doc_id and the digest of the runs of every (planted) text."""
    changed = docs.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs(changed, ["doc_id"], config)
    columns = digest(found)
    return found.select("doc_id", *[c.alias(name) for name, c in columns.items()])
