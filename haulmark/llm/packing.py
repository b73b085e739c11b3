"""Pack documents into sequences: exact-complement hashing of lengths, then best fit.

Only lengths matter, and there are at most ``size`` different ones, however many documents
there are. One aggregate counts the pieces of each length. From these counts a plan is made:
the longest piece opens a sequence, and sums of one, two and three lengths are looked up for
exactly the gap it leaves. Where none fills it, the best fitting piece (the longest that fits)
is added and the sums are looked up for the gap that remains, until nothing fits. A combination
is consumed as often as its counts allow, so the plan takes some steps per length.

The plan says which places in the order of (length, id) go to which sequence and offset. It
has a few rows per length, whatever the table holds, and is the only thing that is shipped;
pieces are numbered in that order by a distributed sort and each looks its place up.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haulmark.llm.tables import numbered, slices, written
from haulmark.llm.text import groups

TOKENIZER = "word_bpe_49k.json"
END = 1  # id that closes a document
_WORD = re.compile("[^ \t\n\x0b\x0c\r]+")
MOST_WORDS = 400_000  # remembered in a task, of up to LONGEST_WORD characters
MOST_IDS = 4_000_000
LONGEST_WORD = 40
TOGETHER = 1_024  # pieces in one call of the library

# How the tokenizer file cuts texts. In texts of Latin characters only, which
# lowering and composing leave alone but for case, the pieces can be cut out beforehand.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STEPS = ["NFC", "Replace", "Lowercase"]
# What lowering or composing could change otherwise, or what may be a special token.
_OTHER = re.compile("[\u0130\u0180-\u200f\u2028-\u202f\u205f-\U0010ffff]|<\\|")


def _latin_pieces() -> re.Pattern:
    """SPLIT for lowered texts without _OTHER; letters first, as no other piece begins so."""
    kinds: dict[str, list[str]] = {"L": [], "N": [], "Z": list("\t\n\x0b\x0c\r\x85")}
    for char in map(chr, range(0x180)):
        kinds.setdefault(unicodedata.category(char)[0], []).append(char)
    letters, numbers, white = (re.escape("".join(kinds[k])) for k in "LNZ")
    return re.compile(
        f"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^{white}{letters}{numbers}]+"
    )


@dataclass(frozen=True)
class PackConfig:
    size: int = 4_096  # tokens of a sequence
    tokenizer: str = TOKENIZER


class Encoder:
    """Token ids of whole texts as the library gives them, piece by piece.

    The tokenizer file cuts a text into pieces (words, digits, signs) before anything looks
    across them, so the ids of a text are those of its pieces. Pieces met before are not
    encoded again; new ones are encoded together. Texts with other than Latin characters are
    cut at white space only. A file that cuts otherwise encodes whole texts.
    """

    def __init__(self, tokenizer: str = TOKENIZER) -> None:
        self._library = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        self._library.no_truncation()
        self._library.no_padding()
        made = json.loads(self._library.to_str())
        steps = (made["normalizer"] or {}).get("normalizers", [])
        cuts = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        self._cuts = [s["type"] for s in steps] == STEPS and cuts.get("pattern") == {"Regex": SPLIT}
        self._latin = _latin_pieces()
        self.forget()

    def forget(self) -> None:
        self._number: dict[str, int] = {}
        self._ids = np.zeros(1 << 16, np.uint32)
        self._starts = np.zeros(1 << 12, np.int64)
        self._lengths = np.zeros(1 << 12, np.int64)
        self._used = 0  # of _ids
        self._words = 0

    def _keep(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        while self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while self._words + len(lengths) > len(self._starts):
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
            self._lengths = np.concatenate([self._lengths, np.zeros_like(self._lengths)])
        self._ids[self._used : self._used + len(ids)] = ids
        new = slice(self._words, self._words + len(lengths))
        self._starts[new], self._lengths[new] = self._used + np.cumsum(lengths) - lengths, lengths
        self._used += len(ids)
        self._words += len(lengths)

    def _learn(self, pieces: list[str], words: list[str]) -> None:
        """Numbers and ids of new pieces, which are encoded together, and new words."""
        for start in range(0, len(pieces), TOGETHER):
            part = pieces[start : start + TOGETHER]
            encoding = self._library.encode(" ".join(part), add_special_tokens=False)
            lengths = np.bincount(np.array(encoding.word_ids, np.int64), minlength=len(part))
            if len(lengths) != len(part):
                raise ValueError("the tokenizer joins or splits pieces")
            self._number.update(zip(part, range(self._words, self._words + len(part)), strict=True))
            self._keep(np.array(encoding.ids, np.uint32), lengths)
        for word in words:
            ids = self._library.encode(word, add_special_tokens=False).ids
            self._number[word] = self._words
            self._keep(np.array(ids, np.uint32), np.array([len(ids)]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without special tokens of the encoder's own."""
        if not self._cuts:
            found = self._library.encode_batch(texts, add_special_tokens=False)
            return [np.array(encoding.ids, np.uint32) for encoding in found]
        if self._words > MOST_WORDS or self._used > MOST_IDS:
            self.forget()
        known = self._number
        latin = [_OTHER.search(text) is None for text in texts]
        cuts = [
            self._latin.findall(text.lower()) if plain else _WORD.findall(text)
            for text, plain in zip(texts, latin, strict=True)
        ]
        counts = np.array([len(cut) for cut in cuts], np.int64)
        parts = list(chain.from_iterable(cuts))
        at = np.fromiter(map(known.get, parts, repeat(-1)), np.int64, len(parts))
        new = np.flatnonzero(at < 0)
        plain = np.repeat(np.array(latin), counts)[new].tolist()
        pieces = {parts[i] for i, p in zip(new.tolist(), plain, strict=True) if p}
        words = {parts[i] for i, p in zip(new.tolist(), plain, strict=True) if not p} - pieces
        self._learn(sorted(pieces), sorted(words))
        at[new] = [known[parts[i]] for i in new.tolist()]
        for word in chain(pieces, words):  # long ones would fill the memory and hardly come again
            if len(word) > LONGEST_WORD:
                del known[word]
        lengths = self._lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        shift = self._starts[at] - (ends - lengths)
        ids = self._ids[np.repeat(shift, lengths) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@cache
def encoder(tokenizer: str) -> Encoder:
    """One for a worker process: what it remembers, which is bounded, serves later tasks."""
    return Encoder(tokenizer)


def token_pieces(
    docs: DataFrame, config: PackConfig = PackConfig(), with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): the pieces of every document.

    A document is its ids and the closing id; one of more than ``size`` is cut into pieces of
    that many, the last of which may be shorter. A null or empty text is the closing id alone.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<bigint>" if with_ids else ""
    size = config.size

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(config.tokenizer).encode
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            row, start, length, check, kept = [], [], [], [], []
            for first, group in groups(texts):
                for i, ids in enumerate(encode(group), first):
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                    for a in range(0, len(ids), size):
                        part = ids[a : a + size]
                        row.append(i)
                        start.append(a)
                        length.append(len(part))
                        check.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            kept.append(part)
            columns = [
                batch.column("doc_id").take(pa.array(row, pa.int64())),
                pa.array([a // size for a in start], pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(check, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                flat = np.concatenate([*kept, np.zeros(0, "<u4")]).astype(np.int64)
                offsets = np.cumsum([0] + length).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


# ---- the plan ---------------------------------------------------------------------------


class Sums:
    """Which sums one, two and three of the lengths at hand can make.

    ``one``, ``two`` and ``three`` count the ordered ways to each sum, lengths repeating
    freely; whether enough pieces are left is seen when a combination is picked.
    """

    def __init__(self, counts: np.ndarray) -> None:
        self.n = len(counts)
        self.one = (counts > 0).astype(np.int64)
        self.two = np.convolve(self.one, self.one)[: self.n]
        self.three = np.convolve(self.two, self.one)[: self.n]

    def remove(self, x: int) -> None:
        """A length of which no piece is left."""

        def shifted(ways: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros(self.n, np.int64)
            if by < self.n:
                out[by:] = ways[: self.n - by]
            return out

        unit = np.zeros(self.n, np.int64)
        unit[0] = 1
        self.three += 3 * shifted(self.one, 2 * x) - 3 * shifted(self.two, x) - shifted(unit, 3 * x)
        self.two += shifted(unit, 2 * x) - 2 * shifted(self.one, x)
        self.one[x] = 0

    def complement(self, gap: int, left: np.ndarray) -> tuple[int, ...] | None:
        """One, two or three lengths that fill the gap exactly, longest first, of which
        ``left`` holds enough pieces."""
        if self.one[gap] and left[gap]:
            return (gap,)
        if self.two[gap]:
            found = self._pair(gap, gap, left)
            if found:
                return found
        if self.three[gap]:
            longest = np.arange(gap - 2, (gap + 2) // 3 - 1, -1)
            longest = longest[(left[longest] > 0) & (self.two[gap - longest] > 0)]
            for x in longest.tolist():
                left[x] -= 1
                found = self._pair(gap - x, x, left)
                left[x] += 1
                if found:
                    return (x, *found)
        return None

    @staticmethod
    def _pair(total: int, most: int, left: np.ndarray) -> tuple[int, int] | None:
        x = np.arange(min(most, total - 1), (total + 1) // 2 - 1, -1)
        if not len(x):
            return None
        y = total - x
        fits = (left[x] > 0) & (left[y] > 0) & ((x != y) | (left[x] > 1))
        at = int(fits.argmax())
        return (int(x[at]), int(y[at])) if fits[at] else None


def bins(counts: np.ndarray, size: int) -> list[tuple[dict[int, int], int]]:
    """Sequences as (pieces by length, how many such sequences there are)."""
    left = counts.copy()
    sums = Sums(left)
    found: list[tuple[dict[int, int], int]] = []
    while True:
        held = np.flatnonzero(left)
        if not len(held):
            return found
        used: dict[int, int] = {}
        gap, pick = size, (int(held[-1]),)
        while pick:
            for x in pick:
                used[x] = used.get(x, 0) + 1
                left[x] -= 1
                gap -= x
            pick = (sums.complement(gap, left) if gap else None) or ()
            if gap and not pick:  # no exact sum: what is left of the gap after the best fit
                fitting = np.flatnonzero(left[: gap + 1])
                pick = (int(fitting[-1]),) if len(fitting) else ()
        for x, n in used.items():
            left[x] += n
        times = min(int(left[x]) // n for x, n in used.items())
        found.append((used, times))
        for x, n in used.items():
            left[x] -= n * times
            if left[x] == 0:
                sums.remove(x)


@dataclass(frozen=True)
class Plan:
    """Rows of places, in order: the pieces from ``first`` on go to sequences from
    ``sequence`` on, ``each`` to a sequence, at ``offset`` and after one another."""

    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def look_up(self, position: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.first, position, "right") - 1
        turn = position - self.first[at]
        each = self.each[at]
        return self.sequence[at] + turn // each, self.offset[at] + turn % each * length


def plan(counts: np.ndarray, size: int) -> Plan:
    """``counts[x]`` pieces of length x become sequences of at most ``size`` tokens."""
    counts = np.asarray(counts, np.int64)
    cursor = np.cumsum(counts) - counts  # place of the next piece of each length
    rows: list[tuple[int, int, int, int]] = []
    sequence = 0
    for content, times in bins(counts, size):
        offset = 0
        for x, each in content.items():
            rows.append((int(cursor[x]), sequence, each, offset))
            cursor[x] += each * times
            offset += each * x
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Plan(*table.T, sequence)


def pack(
    docs: DataFrame, config: PackConfig = PackConfig(), with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset of every piece.

    Null and empty texts are documents of one token. Repeated rows are documents each. Null
    ids come last within a length. Other columns are not read; an empty table gives no rows.
    Texts are encoded once; without ``ids``, what is sorted are the pieces' numbers only.
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, config, with_ids), "pieces")
    counts = np.zeros(config.size + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``size`` rows
        counts[row["length"]] = row["count"]
    order = [F.col("length"), F.col("doc_id").asc_nulls_last()]
    order += [F.col(name) for name in ("piece", "start", "ids_crc32")]
    placed = numbered(pieces, order)
    shipped = spark.sparkContext.broadcast(plan(counts, config.size))
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = np.asarray(batch.column("position"))
            length = np.asarray(batch.column("length"))
            sequence, offset = shipped.value.look_up(position, length)
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return placed.select(*names, "position").mapInArrow(
        place, f"{kinds}, sequence_id bigint, offset bigint"
    )


def sequences(docs: DataFrame, config: PackConfig = PackConfig()) -> DataFrame:
    """sequence_id, ids, doc_ids: the packed sequences, each with its documents in order.

    A group is one sequence, so its size is bounded.
    """
    part = F.struct("offset", "doc_id", "ids")
    placed = pack(docs, config, with_ids=True)
    packed = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return packed.select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
    )
