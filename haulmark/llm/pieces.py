"""Encode texts into word pieces and back: unigram Viterbi over a double-array trie.

The pieces and their log scores come from a SentencePiece model file. A text gets a marker in
front and one for each space; of all ways to cut it into pieces the one of the highest sum of
scores is taken. A character without a piece falls back to its UTF-8 bytes. Decoding joins
the pieces' bytes, turns markers into spaces and removes the first.

Where two neighbouring characters stand side by side in no piece, every segmentation cuts, so
the best one is found for each stretch between such places alone, once for equal stretches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm.tables import map_texts
from haulmark.llm.text import groups, owners, span_hashes

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
MOST_STRETCHES = 150_000  # remembered by a task
_UNKNOWN_COST = 10.0  # below the lowest score, for each character without a piece
_RAW_MARKER = 0x110000  # stands for a marker character of the text itself, which has no piece
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class Vocabulary:
    """Pieces with scores, by id; bytes and control pieces apart."""

    def __init__(self, pieces: list[str], scores: list[float], special: set[int]) -> None:
        self.byte_id: dict[int, int] = {}
        self.bytes_of: list[bytes] = []
        entries: list[tuple[tuple[int, ...], int]] = []
        self.score = np.array(scores)
        for i, piece in enumerate(pieces):
            found = _BYTE.fullmatch(piece)
            if found:
                self.byte_id[int(found[1], 16)] = i
                self.bytes_of.append(bytes([int(found[1], 16)]))
            else:
                self.bytes_of.append(b"" if i in special else piece.replace(MARKER, " ").encode())
                if i not in special and piece:
                    entries.append((tuple(map(ord, piece)), i))
        if len(self.byte_id) != 256:
            raise ValueError("the model has no piece for each byte, so it cannot fall back")
        self.unknown_score = min((scores[i] for _, i in entries), default=0.0) - _UNKNOWN_COST
        alphabet = sorted({c for spelling, _ in entries for c in spelling})
        # Dense codes from 1; 0 is any character that no piece holds.
        self.code = np.zeros(_RAW_MARKER + 1, np.int32)
        self.code[alphabet] = np.arange(1, len(alphabet) + 1)
        self.joined = np.zeros((len(alphabet) + 1, len(alphabet) + 1), bool)
        for spelling, _ in entries:
            at = self.code[list(spelling)]
            self.joined[at[:-1], at[1:]] = True
        self._build([(tuple(self.code[list(s)].tolist()), i) for s, i in entries])
        self.forget()

    def _build(self, entries: list[tuple[tuple[int, ...], int]]) -> None:
        """Double array: the child of node n by code c is base[n] + c if check there is n."""
        children: list[dict[int, int]] = [{}]
        piece = [-1]
        for spelling, i in entries:
            node = 0
            for c in spelling:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    piece.append(-1)
                node = children[node][c]
            piece[node] = i
        width = int(self.code.max()) + 2
        size = 4 * len(children) + width
        base, check, leaf = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        place, bases = {0: 0}, {}
        # First free slot above all codes, and where nodes of several children are tried.
        hole, crowded = width, 1
        for node in sorted(range(len(children)), key=lambda n: -len(children[n])):
            codes = sorted(children[node])
            if not codes:
                continue
            if len(codes) == 1:
                while check[hole] != -1:
                    hole += 1
                at = hole - codes[0]
            else:
                at = crowded
            tried = 0
            while any(check[at + c] != -1 for c in codes):
                at += 1
                tried += 1
                if at + width >= len(check):
                    more = len(check)
                    base += [0] * more
                    check += [-1] * more
                    leaf += [-1] * more
            if len(codes) > 1 and tried > 20:
                crowded = max(crowded, at - 10)
            bases[node] = at
            for c in codes:
                check[at + c] = -2  # taken; the parent's own place may not be known yet
                place[children[node][c]] = at + c
        for node, here in place.items():
            leaf[here], base[here] = piece[node], bases.get(node, 0)
            for child in children[node].values():
                check[place[child]] = here
        self.base, self.check, self.leaf = base, check, leaf

    def forget(self) -> None:
        """Stretches met so far, and their ids as the bytes of 32-bit numbers."""
        self.known: dict[int, bytes] = {}

    def segment(self, codes: list[int], points: list[int]) -> list[int]:
        """Ids of the best segmentation; among equals the one whose last pieces are longest."""
        base, check, leaf, score = self.base, self.check, self.leaf, self._score_list
        n, size = len(codes), len(self.check)
        best, back = [0.0] + [float("-inf")] * n, [(0, -1)] * (n + 1)
        for start in range(n):
            here, node, at = best[start], 0, start
            single = False
            while at < n:
                code = codes[at]
                following = base[node] + code
                if not code or following >= size or check[following] != node:
                    break
                if not base[node]:
                    break
                node, at = following, at + 1
                if leaf[node] >= 0:
                    single |= at == start + 1
                    total = here + score[leaf[node]]
                    if total > best[at]:
                        best[at], back[at] = total, (start, leaf[node])
            if not single and here + self.unknown_score > best[start + 1]:
                best[start + 1], back[start + 1] = here + self.unknown_score, (start, -1)
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            if piece >= 0:
                ids.append(piece)
            else:
                point = points[start]
                character = MARKER if point == _RAW_MARKER else chr(point)
                ids += [self.byte_id[b] for b in reversed(character.encode())]
            at = start
        return ids[::-1]

    @property
    def _score_list(self) -> list[float]:
        if not hasattr(self, "_scores"):
            self._scores = self.score.tolist()
        return self._scores

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of each text's ids."""
        points = np.frombuffer(
            "".join([" " + t for t in texts]).encode("utf-32-le"), np.uint32
        ).copy()
        counts = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        text_starts = np.concatenate([[0], np.cumsum(counts)])
        points[points == ord(MARKER)] = _RAW_MARKER
        points[points == 32] = ord(MARKER)
        empty = counts == 1  # an empty text gets no marker
        codes = self.code[points]
        begins = np.ones(len(points), bool)
        begins[1:] = ~self.joined[codes[:-1], codes[1:]]
        begins[text_starts[:-1]] = True
        starts = np.flatnonzero(begins)
        stops = np.append(starts[1:], len(points))
        keys, first, inverse = np.unique(
            span_hashes(points, starts, stops), return_index=True, return_inverse=True
        )
        if len(self.known) > MOST_STRETCHES:
            self.forget()
        found: list[bytes] = []
        for key, j in zip(keys.tolist(), first.tolist(), strict=True):
            ids = self.known.get(key)
            if ids is None:
                a, b = starts[j], stops[j]
                own = self.segment(codes[a:b].tolist(), points[a:b].tolist())
                ids = self.known[key] = np.array(own, np.int32).tobytes()
            found.append(ids)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.int32)
        offsets = np.cumsum(lengths) - lengths
        owner = owners(starts, text_starts)
        wanted = ~empty[owner]
        inverse, owner = inverse[wanted], owner[wanted]
        n = lengths[inverse]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        ids = flat[np.repeat(offsets[inverse], n) + within]
        return ids, np.bincount(owner, n, len(texts)).astype(np.int64)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        joined = b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")
        return joined[1:] if joined.startswith(" ") else joined


def load(path: str | None = None) -> tuple[list[str], list[float], set[int]]:
    """Pieces, scores, and ids of control and unknown pieces of a model file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
    ids = range(model.get_piece_size())
    special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    return [model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], special


_compiled: dict[str, Vocabulary] = {}


def _vocabulary(shipped) -> Vocabulary:
    """One per worker, whatever the number of tasks."""
    key, spec = shipped.value
    if key not in _compiled:
        _compiled[key] = Vocabulary(*spec)
    return _compiled[key]


def _ship(spark: SparkSession, path: str | None):
    return spark.sparkContext.broadcast((path or MODEL, load(path)))


def encode(docs: DataFrame, keep: list[str], path: str | None = None) -> DataFrame:
    """``keep`` columns, ids, n_ids, n_fallback and same (decoding gives the text) of every row.

    Null and empty texts have no ids, and are the same as the empty text. Whole texts of any
    length are read. The tokenizer file is read by the driver; its pieces are sent to the tasks.
    """
    shipped = _ship(docs.sparkSession, path)

    def cut(texts: list[str | None]) -> Iterator[tuple[int, int, list[pa.Array]]]:
        vocabulary = _vocabulary(shipped)
        is_byte = np.zeros(len(vocabulary.bytes_of), bool)
        is_byte[list(vocabulary.byte_id.values())] = True
        for start, group in groups(texts):
            ids, n = vocabulary.encode(group)
            ends = np.cumsum(n)
            listed = ids.tolist()
            bounds = zip((ends - n).tolist(), ends.tolist(), group, strict=True)
            same = [vocabulary.decode(listed[a:b]) == text for a, b, text in bounds]
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            fallback = np.concatenate([[0], np.cumsum(is_byte[ids])])
            yield start, len(group), [
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32())),
                pa.array(n, pa.int64()),
                pa.array(fallback[ends] - fallback[ends - n], pa.int64()),
                pa.array(same, pa.bool_()),
            ]

    added = {"ids": "array<int>", "n_ids": "bigint", "n_fallback": "bigint", "same": "boolean"}
    return map_texts(docs, keep, added, cut, lambda: _vocabulary(shipped).forget())


def decode(rows: DataFrame, keep: list[str], path: str | None = None) -> DataFrame:
    """``keep`` columns and text of rows with ``ids``; null ids give null."""
    shipped = _ship(rows.sparkSession, path)
    schema = rows.select(*keep).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shipped)
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            texts = [None if ids is None else vocabulary.decode(ids) for ids in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f"_{i}") for i in range(len(keep))] + [pa.array(texts, pa.string())],
                names=[*keep, "text"],
            )

    named = rows.select(
        F.col("ids").alias("ids"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)]
    )
    return named.mapInArrow(join, f"{columns}, text string")
