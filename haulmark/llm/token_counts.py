"""Token counts by compiled finite-state machines instead of a tokenizer's merge loop.

The counts are those of a byte-level BPE file. Two deterministic transducers are compiled:

* ``Splitter`` reads classes of characters and marks where a piece (word, number, symbols,
  white space) starts. It has a dozen states. A batch is cut into chunks; each chunk is read
  from every state at once, which gives its state map; the maps are composed by a parallel
  prefix scan, so that every chunk then knows the state it is entered in.
* ``Counter`` reads the bytes of a piece. Each transition carries the change of the number
  of tokens. It is determinised as bytes are met; the states first met are kept.

Why a finite machine can follow BPE: a sequence of tokens is the encoding of its bytes if and
only if each two neighbours are the encoding of theirs. So the last token of the encoding of a
prefix is the one token ending there that fits the last token of the prefix before it, and
only starts from which some token still goes on have to be remembered.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.text import groups, owners, span_hashes

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1_024
CHUNK = 64
MOST_STATES = 60_000  # that the machine keeps; rarer ones are worked out as they are met
MOST_PIECES = 400_000  # remembered per worker
END = 0x110000  # a code point that no text holds, after each text

# ---- where pieces start ----------------------------------------------------------------

# Classes. Letters that can end a contraction are told apart.
LETTER, SDMT, R, V, E, L, NUMBER, SPACE, WHITE, QUOTE, SYMBOL, STOP, SKIP = range(13)
_LETTERS = (LETTER, SDMT, R, V, E, L)
_WHITE = (SPACE, WHITE)
# The characters of Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"

# States: what the machine stands in.
FRESH, WORD, DIGITS, SYMBOLS, QUOTED, QUOTE_R, QUOTE_V, QUOTE_L, ONE_SPACE, ONE_WHITE, RUN_SPACE, RUN_WHITE = range(12)
HERE, BEFORE = 1, 2  # a piece starts at this character, at the one before


@cache
def class_table() -> np.ndarray:
    table = np.full(END + 1, SYMBOL, np.uint8)
    for i in range(END):
        major = unicodedata.category(chr(i))[0]
        if major == "L":
            table[i] = LETTER
        elif major == "N":
            table[i] = NUMBER
    for chars, kind in ((WHITE_SPACE, WHITE), (" ", SPACE), ("'", QUOTE), ("sdmt", SDMT),
                        ("r", R), ("v", V), ("e", E), ("l", L)):
        table[[ord(c) for c in chars]] = kind
    table[END] = STOP
    return table


def _step(state: int, kind: int) -> tuple[int, int]:
    """Next state, and which characters start a piece."""
    fresh = {NUMBER: DIGITS, SPACE: ONE_SPACE, WHITE: ONE_WHITE, QUOTE: QUOTED, SYMBOL: SYMBOLS}
    start = (fresh.get(kind, WORD), HERE)
    if kind == SKIP:
        return state, 0
    half = {QUOTE_R: E, QUOTE_V: E, QUOTE_L: L}.get(state)
    if kind == STOP:  # a letter after a quote was a word after all
        return FRESH, BEFORE if half is not None else 0
    if half is not None:
        if kind == half:
            return FRESH, 0
        following, mark = _step(WORD, kind)
        return following, mark | BEFORE
    if state in (ONE_SPACE, ONE_WHITE, RUN_SPACE, RUN_WHITE):
        if kind in _WHITE:
            return (RUN_SPACE if kind == SPACE else RUN_WHITE), 0
        mark = BEFORE if state in (RUN_SPACE, RUN_WHITE) else 0
        if state in (ONE_SPACE, RUN_SPACE):  # one space belongs to what follows
            return {NUMBER: DIGITS, QUOTE: SYMBOLS, SYMBOL: SYMBOLS}.get(kind, WORD), mark
        return start[0], mark | HERE
    if state == QUOTED:
        if kind == SDMT:
            return FRESH, 0
        if kind in (R, V, L):
            return {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[kind], 0
        return (SYMBOLS, 0) if kind in (QUOTE, SYMBOL) else start
    inside = {WORD: _LETTERS, DIGITS: (NUMBER,), SYMBOLS: (QUOTE, SYMBOL)}.get(state, ())
    return (state, 0) if kind in inside else start


@cache
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Transitions and marks, indexed by class * states + state."""
    pairs = [_step(state, kind) for kind in range(13) for state in range(12)]
    return np.array([p[0] for p in pairs], np.uint8), np.array([p[1] for p in pairs], np.uint8)


def entry_states(kinds: np.ndarray) -> np.ndarray:
    """The state each chunk (a row of classes) is entered in.

    First every chunk's state map, then all maps composed with those before them, in as many
    rounds as the number of chunks has binary digits.
    """
    move, _ = splitter()
    n = len(kinds)
    maps = np.tile(np.arange(12, dtype=np.uint8), (n, 1))
    for column in range(kinds.shape[1]):
        maps = move[kinds[:, column, None].astype(np.int16) * 12 + maps]
    reach = 1
    while reach < n:
        composed = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        maps = np.concatenate([maps[:reach], composed])
        reach *= 2
    return np.concatenate([[FRESH], maps[:-1, FRESH]]).astype(np.uint8)


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Where pieces start in texts of which each is followed by END."""
    n = len(points)
    kinds = np.full(-(-n // CHUNK) * CHUNK, SKIP, np.uint8)
    kinds[:n] = class_table()[points]
    kinds = kinds.reshape(-1, CHUNK)
    move, mark = splitter()
    state = entry_states(kinds)
    marks = np.empty_like(kinds)
    for column in range(CHUNK):
        at = kinds[:, column].astype(np.int16) * 12 + state
        marks[:, column] = mark[at]
        state = move[at]
    marks = marks.reshape(-1)[:n]
    starts = (marks & HERE).astype(bool)
    starts[:-1] |= (marks[1:] & BEFORE).astype(bool)
    return np.flatnonzero(starts)


# ---- tokens of a piece -----------------------------------------------------------------


def _byte_alphabet() -> dict[str, int]:
    """Byte of each character that stands for one in the file: printable ones for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


class Counter:
    """Deterministic transducer from bytes to changes of the number of tokens."""

    def __init__(self, spec: bytes) -> None:
        data = json.loads(spec)
        letter = _byte_alphabet()
        self.specials = [t["content"] for t in data["added_tokens"]]
        vocabulary = {
            bytes(letter[c] for c in token): number
            for token, number in data["model"]["vocab"].items()
            if all(c in letter for c in token) and token not in self.specials
        }
        ids = data["model"]["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.split: dict[int, tuple[int, tuple[int, int]]] = {}  # how a token is made
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            pair, made = (ids[left], ids[right]), ids[left + right]
            self.merges[pair] = (rank, made)
            self.split.setdefault(made, (rank, pair))
        # A trie of the tokens: child of node << 8 | byte, token of a node, nodes with children.
        self.child: dict[int, int] = {}
        self.token = [-1]
        self.inner: set[int] = set()
        for spelling, number in vocabulary.items():
            node = 0
            for byte in spelling:
                self.inner.add(node)
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                node = self.child[key]
            self.token[node] = number
        self.fits: dict[int, bool] = {}
        self.pieces: dict[int, int] = {}
        # A state: last token, and (trie node, token before its start, tokens since then).
        self.states: list[tuple[int, tuple]] = [(-1, ())]
        self.number = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at one edge of a token while it is merged together.

        From its first or last byte up to itself, each with the rank of the merge that uses
        it up.
        """
        rank, edge = float("inf"), []
        while True:
            edge.append((token, rank))
            if token not in self.split:
                return edge[::-1]
            rank, pair = self.split[token]
            token = pair[side]

    def _fit(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, are the encoding of their bytes.

        Merges run by ascending rank and use only what lower ranks made. So it is enough to
        follow the two tokens that touch: a merge across the seam must come before the
        one that uses up the left of them, and no later than the one that uses up the right.
        """
        if len(self.fits) > MOST_PIECES:
            self.fits.clear()
        one, other = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        known = True
        while True:
            (a, until_a), (b, until_b) = one[i], other[j]
            rank = self.merges.get((a, b), (None,))[0]
            if rank is not None and rank < until_a and rank <= until_b:
                known = False
                break
            if i + 1 == len(one) and j + 1 == len(other):
                break
            if until_a <= until_b:
                i += 1
            else:
                j += 1
        self.fits[left << 32 | right] = known
        return known

    def _read(self, last: int, live: tuple, byte: int) -> tuple[int, int, tuple]:
        """Last token, change of the count, and live starts after one more byte."""
        step, tokens, fits = self.child, self.token, self.fits
        going, found, change = [], -1, 0
        for node, before, since in (*live, (0, last, 0)):
            node = step.get(node << 8 | byte)
            if node is None:
                continue
            token = tokens[node]
            if token >= 0 and found < 0:
                fit = before < 0 or fits.get(before << 32 | token)
                if fit is None:
                    fit = self._fit(before, token)
                if fit:
                    found, change = token, 1 - since
            if node in self.inner:
                going.append((node, before, since))
        if found < 0:
            raise ValueError("no token ends here; the file is no byte-level BPE")
        if change:
            return found, change, tuple([(n, b, s + change) for n, b, s in going])
        return found, 0, tuple(going)

    def count(self, piece: bytes) -> int:
        """Tokens of a piece: along compiled transitions, compiling what is new."""
        state = total = 0
        moves, states = self.moves, self.states
        for i, byte in enumerate(piece):
            move = moves.get(state << 8 | byte)
            if move is None:
                last, change, live = self._read(*states[state], byte)
                target = self.number.get((last, live))
                if target is None:
                    if len(states) >= MOST_STATES:  # full: read on without keeping states
                        total += change
                        for later in piece[i + 1 :]:
                            last, change, live = self._read(last, live, later)
                            total += change
                        return total
                    target = self.number[last, live] = len(states)
                    states.append((last, live))
                move = moves[state << 8 | byte] = (target, change)
            state = move[0]
            total += move[1]
        return total

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; strings of added tokens inside a text are one token each."""
        extra = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, text in enumerate(texts):
            split = [text]
            for special in self.specials:
                split = [x for part in split for x in part.split(special)]
            extra[i] = len(split) - 1
            parts += split
            owner += [i] * len(split)
        return extra + np.bincount(owner, self._counts(parts), len(texts)).astype(np.int64)

    def _counts(self, texts: list[str]) -> np.ndarray:
        joined = " ".join(texts) + " "
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        points[ends - 1] = END
        text_starts = np.concatenate([[0], ends])
        starts = piece_starts(points)
        if not len(starts):
            return np.zeros(len(texts), np.int64)
        owner = owners(starts, text_starts)
        stops = np.minimum(np.append(starts[1:], len(points)), ends[owner] - 1)
        hashes, first, inverse = np.unique(
            span_hashes(points, starts, stops), return_index=True, return_inverse=True
        )
        if len(self.pieces) > MOST_PIECES:
            self.pieces.clear()
        known = self.pieces
        found = np.empty(len(hashes), np.int64)
        begin, end = starts[first].tolist(), stops[first].tolist()
        for i, key in enumerate(hashes.tolist()):
            n = known.get(key)
            if n is None:
                n = known[key] = self.count(joined[begin[i] : end[i]].encode())
            found[i] = n
        return np.bincount(owner, found[inverse], len(texts))


@cache
def _counter(spec: bytes) -> Counter:
    return Counter(spec)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    Null texts count as empty: no bytes, no tokens. Texts of any length are read whole;
    other columns are not. The tokenizer file is read by the driver and sent to the tasks.
    """
    with open(path or public_tokenizers.path(TOKENIZER), "rb") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(spec.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            parts = [counter.counts(group) for _, group in groups(texts)]
            found = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(found, pa.int64()),
                 pa.array(found > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes")
    )
    return rows.mapInArrow(
        count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
