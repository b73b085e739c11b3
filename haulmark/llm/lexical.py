"""Ranked lexical search: a dual-tree search of documents for a table of items.

A document's vector holds, for each term, its occurrences damped by the document's length; an
item's vector holds the weights of its terms. The score is their inner product in whole
numbers. Two hierarchies, one over items and one over documents, hold the maximum of each
coordinate in every node, so the inner product of two nodes bounds the score of every pair
below them. A pair of nodes whose bound is below the weakest k-th score of the node's items is
dropped with all that is below; what is left is split on both sides, down to single documents.

Items come in blocks of bounded size (usually there is one). For a block, one pass over the
documents turns whole texts into counts of the block's terms, which are written. Statistics
cover all documents. A bounded sample of them gives first thresholds, which only make the
search faster; then every partition searches its own documents, and the best of all partitions
are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.tables import numbered, slices, written
from haulmark.llm.text import codes, groups, owners, span_hashes, spans

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOOK_TASKS = 4
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class SearchConfig:
    k: int = 50
    block_terms: int = 50_000  # terms of a block of items; an item with more is a block alone
    first_look: int = 8_192  # documents, about, that give the first thresholds
    cells: int = 16_000_000  # of a group of documents: their number times the block's terms
    fan: int = 8  # children of a node
    item_leaf: int = 4
    doc_leaf: int = 16


def item_terms(text: Column) -> Column:
    """The distinct terms of a text, null if there is none."""
    lowered = F.translate(text, _UPPER, _UPPER.lower())
    found = F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"({TERM})")))
    return F.when(F.size(found) > 0, found)


# ---- texts to counts of terms -----------------------------------------------------------


def term_spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered code points, starts and stops of all terms, and the text each is in."""
    points, text_starts = codes(texts)
    upper = (points >= 65) & (points <= 90)
    points = points + upper * np.uint32(32)
    inside = (points > 127) | ((points >= 97) & (points <= 122)) | ((points >= 48) & (points <= 57))
    starts, stops = spans(inside)
    return points, starts, stops, owners(starts, text_starts)


class Vocabulary:
    """Numbers of terms. A term is looked up by a hash and compared with what is found."""

    def __init__(self, terms: list[str]) -> None:
        self.size = len(terms)
        self.points, bounds = codes(terms)
        starts, stops = bounds[:-1], bounds[1:] - 1
        hashed = span_hashes(self.points, starts, stops)
        self.term = np.argsort(hashed, kind="stable")
        self.hashed = hashed[self.term]
        self.starts, self.lengths = starts[self.term], (stops - starts)[self.term]
        twins = bool((self.hashed[1:] == self.hashed[:-1]).any())
        self.known = {t: i for i, t in enumerate(terms)} if twins else None

    def find(self, points: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The number of each span's term, -1 where it is not known."""
        if self.known is not None:  # two terms of one hash
            texts = (points[a:b].tobytes().decode("utf-32-le", "surrogatepass") for a, b in zip(starts, stops, strict=True))
            return np.fromiter((self.known.get(t, -1) for t in texts), np.int64, len(starts))
        if not self.size or not len(starts):
            return np.full(len(starts), -1, np.int64)
        at = np.searchsorted(self.hashed, (hashed := span_hashes(points, starts, stops)))
        at[at == self.size] = 0
        lengths = stops - starts
        same = (self.hashed[at] == hashed) & (self.lengths[at] == lengths)
        index, lengths = np.flatnonzero(same), lengths[same]
        if len(index):
            first = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
            own = points[np.repeat(starts[index], lengths) + place]
            model = self.points[np.repeat(self.starts[at[index]], lengths) + place]
            same[index] = np.logical_and.reduceat(own == model, first)
        return np.where(same, self.term[at], -1)


def count_terms(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, n (all terms, with repeats), terms, times: the block's terms in each document."""
    shipped = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shipped.value)
        width = max(1, vocabulary.size)
        for batch in slices(batches):
            ids = batch.column("doc_id")
            for first, group in groups(batch.column("text").to_pylist()):
                points, starts, stops, owner = term_spans(group)
                found = vocabulary.find(points, starts, stops)
                key = owner[found >= 0] * width + found[found >= 0]
                key, times = np.unique(key, return_counts=True)
                bounds = np.searchsorted(key, np.arange(len(group) + 1) * width).astype(np.int32)
                offsets = pa.array(bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(group)),
                        pa.array(np.bincount(owner, minlength=len(group))),
                        pa.ListArray.from_arrays(offsets, pa.array((key % width).astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                    ],
                    names=["doc_id", "n", "terms", "times"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id bigint, n bigint, terms array<int>, times array<int>")


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term is; one row a term and task, then one a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            terms = batch.column("terms").flatten()
            total += np.bincount(np.asarray(terms), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "df"]
        )

    rows = counted.select("terms").mapInArrow(count, "term int, df bigint")
    found = np.zeros(size, np.int64)
    for row in rows.groupBy("term").agg(F.sum("df").alias("df")).collect():  # the block's terms
        found[row["term"]] = row["df"]
    return found


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64
    )


# ---- the two trees ----------------------------------------------------------------------


@dataclass(frozen=True)
class ItemNode:
    items: np.ndarray  # all items below
    terms: np.ndarray  # ascending
    most: np.ndarray  # weight of each term: the largest of any item below
    children: tuple[ItemNode, ...]
    exact: np.ndarray | None  # of a leaf: items x terms


def item_tree(vectors: list[np.ndarray], weight: np.ndarray, config: SearchConfig) -> ItemNode:
    """``vectors`` are the items' terms. Items are ordered by their heaviest terms, so that
    those of a node have terms in common."""
    heavy = [tuple(sorted(v.tolist(), key=lambda t: (-weight[t], t))[:3]) for v in vectors]
    order = sorted(range(len(vectors)), key=lambda i: (heavy[i], i))

    def leaf(items: list[int]) -> ItemNode:
        terms = np.unique(np.concatenate([vectors[i] for i in items]))
        exact = np.zeros((len(items), len(terms)), np.int64)
        for row, i in enumerate(items):
            at = np.searchsorted(terms, vectors[i])
            exact[row, at] = weight[vectors[i]]
        return ItemNode(np.array(items), terms, exact.max(axis=0), (), exact)

    def above(children: list[ItemNode]) -> ItemNode:
        terms = np.unique(np.concatenate([c.terms for c in children]))
        most = np.zeros(len(terms), np.int64)
        for c in children:
            at = np.searchsorted(terms, c.terms)
            most[at] = np.maximum(most[at], c.most)
        return ItemNode(np.concatenate([c.items for c in children]), terms, most, tuple(children), None)

    level = [
        leaf(order[i : i + config.item_leaf]) for i in range(0, len(order), config.item_leaf)
    ]
    while len(level) > 1:
        level = [above(level[i : i + config.fan]) for i in range(0, len(level), config.fan)]
    return level[0]


@dataclass(frozen=True)
class Documents:
    """A group of documents in the order of their tree: ids and, by level, terms x nodes."""

    ids: np.ndarray
    no_id: np.ndarray
    levels: list[np.ndarray]  # documents, leaves, nodes of leaves, ...
    fans: list[int]  # children of a node of the level above


def document_tree(
    ids: np.ndarray,
    no_id: np.ndarray,
    owner: np.ndarray,
    term: np.ndarray,
    value: np.ndarray,
    weight: np.ndarray,
    config: SearchConfig,
) -> Documents:
    """Documents are ordered by the term that adds most to their scores, so that documents
    that share a rare term, and copies, are in one node."""
    n = len(ids)
    gain = weight[term] * value
    best = np.lexsort((term, -gain, owner))
    firsts = best[np.flatnonzero(np.append(True, owner[best][1:] != owner[best][:-1]))] if len(best) else best
    heaviest = np.full(n, -1, np.int64)
    largest = np.zeros(n, np.int64)
    heaviest[owner[firsts]], largest[owner[firsts]] = term[firsts], gain[firsts]
    order = np.lexsort((-largest, heaviest))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    table = np.zeros((len(weight), n), np.float32)  # values up to 10**6: exact
    table[term, place[owner]] = value
    levels, fans = [table], []
    fan = config.doc_leaf
    while levels[-1].shape[1] > 1:
        below = levels[-1]
        starts = np.arange(0, below.shape[1], fan)
        levels.append(np.maximum.reduceat(below, starts, axis=1))
        fans.append(fan)
        fan = config.fan
    return Documents(ids[order], no_id[order], levels, fans)


class Best:
    """The best k documents of each item so far, and the score that a further one must reach."""

    def __init__(self, n_items: int, k: int, least: np.ndarray | None = None) -> None:
        self.k = k
        self.least = np.ones(n_items, np.int64) if least is None else np.maximum(least, 1)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        ] * n_items

    def add(self, item: int, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        s, i, z = self.found[item]
        s, i, z = np.append(s, score), np.append(i, ids), np.append(z, no_id)
        order = np.lexsort((i, z, -s))[: self.k]
        self.found[item] = s[order], i[order], z[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], s[order[-1]])


_DOUBLES = 1 << 53


def search(root: ItemNode, docs: Documents, best: Best) -> int:
    """Add the documents to the best of each item; returns how many scores were worked out."""
    worked = 0

    def product(left: np.ndarray, terms: np.ndarray, level: int, nodes: np.ndarray) -> np.ndarray:
        right = docs.levels[level][np.ix_(terms, nodes)]
        if 10**6 * int(left.sum(axis=-1).max(initial=0)) < _DOUBLES:  # sums are exact
            return (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
        return left @ right.astype(np.int64)

    def below(level: int, nodes: np.ndarray) -> np.ndarray:
        fan, n = docs.fans[level - 1], docs.levels[level - 1].shape[1]
        children = (nodes[:, None] * fan + np.arange(fan)).ravel()
        return children[children < n]

    def visit(node: ItemNode, level: int, nodes: np.ndarray) -> None:
        nonlocal worked
        while True:
            if level == 0 and node.exact is not None:
                score = product(node.exact, node.terms, 0, nodes)
                worked += score.size
                for row, item in enumerate(node.items.tolist()):
                    good = np.flatnonzero(score[row] >= best.least[item])
                    if len(good):
                        at = nodes[good]
                        best.add(item, score[row][good], docs.ids[at], docs.no_id[at])
                return
            bound = product(node.most, node.terms, level, nodes)
            nodes = nodes[bound >= best.least[node.items].min()]
            if not len(nodes):
                return
            if level:
                nodes, level = below(level, nodes), level - 1
            if node.children:
                for child in node.children:
                    visit(child, level, nodes)
                return

    top = len(docs.levels) - 1
    visit(root, top, np.arange(docs.levels[top].shape[1]))
    return worked


# ---- all documents ----------------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """What a task needs to search for a block of items."""

    vectors: list[np.ndarray]
    weight: np.ndarray
    n_docs: int
    n_terms: int
    least: np.ndarray | None
    config: SearchConfig

    def documents(self, batch: pa.RecordBatch) -> Documents:
        ids = batch.column("doc_id")
        n = np.asarray(batch.column("n"))
        lists = batch.column("terms")
        term, times = np.asarray(lists.flatten()), np.asarray(batch.column("times").flatten())
        owner = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
        damp = 50 + (50 * n * self.n_docs) // max(1, self.n_terms)
        times = times.astype(np.int64)
        value = 1_000_000_000 * times // (1000 * times + 20 * damp[owner])
        return document_tree(
            np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), owner, term, value, self.weight, self.config
        )

    def run(self, batches: Iterator[pa.RecordBatch]) -> tuple[Best, int]:
        best, worked = Best(len(self.vectors), self.config.k, self.least), 0
        root = item_tree(self.vectors, self.weight, self.config)
        rows = max(self.config.doc_leaf, min(4096, self.config.cells // max(1, len(self.weight))))
        for part in slices(batches, rows):
            worked += search(root, self.documents(part), best)
        return best, worked


def _searched(counted: DataFrame, block: Block) -> DataFrame:
    """item, doc_id, score: the best k of each partition."""
    shipped = counted.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, _ = shipped.value.run(batches)
        sizes = [len(s) for s, _, _ in best.found]
        score, ids, no_id = (np.concatenate(column) for column in zip(*best.found, strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(sizes)), sizes).astype(np.int32)),
                pa.array(ids, mask=no_id),
                pa.array(score),
            ],
            names=["item", "doc_id", "score"],
        )

    return counted.mapInArrow(run, "item int, doc_id bigint, score bigint")


def _blocks(items: DataFrame, config: SearchConfig) -> tuple[DataFrame, int]:
    """block, item, item_id, term of the items with terms, and the number of blocks."""
    rows = written(items.select("item_id", item_terms(F.col("text")).alias("terms")), "items")
    kept = numbered(
        rows.filter(F.col("terms").isNotNull()),
        [F.col("item_id").asc_nulls_last(), F.xxhash64("terms"), F.col("terms")],
        "item",
    )
    pairs = written(kept.select("item", "item_id", F.explode("terms").alias("term")), "pairs")
    placed = written(numbered(pairs, [F.col("item"), F.col("term")], "place"), "placed")
    own = F.floor(F.min("place") / config.block_terms).cast("int")  # of the item's first term
    block = placed.groupBy("item").agg(own.alias("block"))
    found = written(placed.join(block, "item").drop("place"), "blocks")
    last = found.agg(F.max("block")).first()[0]
    return found, 0 if last is None else last + 1


def ranked(
    docs: DataFrame, items: DataFrame, config: SearchConfig = SearchConfig()
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents of score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text. Terms are runs of ASCII letters
    and digits and of all characters beyond ASCII, A to Z lowered. Ties go to the smaller
    doc_id, null ids last. Null texts and texts without terms are found by none and find
    none. Repeated documents are found each; repeated items, or several under one id, have a
    list each. Other columns are not read. Whole texts of any length are read.
    """
    spark = docs.sparkSession
    wanted, n_blocks = _blocks(items, config)
    lists: list[DataFrame] = []
    for number in range(n_blocks):
        rows = wanted.filter(F.col("block") == number).orderBy("item").collect()
        terms = sorted({r["term"] for r in rows})
        place = {t: i for i, t in enumerate(terms)}
        numbers = {item: i for i, item in enumerate(dict.fromkeys(r["item"] for r in rows))}
        vectors: list[list[int]] = [[] for _ in numbers]
        names = [None] * len(numbers)
        for r in rows:
            vectors[numbers[r["item"]]].append(place[r["term"]])
            names[numbers[r["item"]]] = r["item_id"]
        counted = written(count_terms(docs, terms), "counted")
        n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        weight = weights(document_frequencies(counted, len(terms)), n_docs)
        sorted_vectors = [np.array(sorted(v), np.int64) for v in vectors]
        block = Block(sorted_vectors, weight, n_docs, n_terms, None, config)
        some = counted.filter(F.size("terms") > 0)
        # About ``first_look`` documents by hash, whatever the size of the table.
        share = min(1.0, config.first_look / max(1, n_docs))
        drawn = F.pmod(F.xxhash64("doc_id", "terms", "times"), F.lit(1 << 40)) < int(share * (1 << 40))
        look = some.filter(drawn).repartition(_LOOK_TASKS)
        least = np.zeros(len(vectors), np.int64)
        kth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        first = _searched(look, block).withColumn("_kth", kth).filter(F.col("_kth") == config.k)
        for r in first.select("item", "score").collect():  # a row an item of the block
            least[r["item"]] = r["score"]
        block = Block(sorted_vectors, weight, n_docs, n_terms, least, config)
        named = spark.createDataFrame(
            list(enumerate(names)), f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
        )
        found = _searched(some, block)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= config.k)
        lists.append(
            best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
        )
    if not lists:
        return items.select("item_id").limit(0).selectExpr(
            "item_id", "cast(0 as int) as rank", "cast(0 as bigint) as doc_id", "cast(0 as bigint) as score"
        )
    out = lists[0]
    for more in lists[1:]:
        out = out.unionByName(more)
    return out
