"""Ranked lexical search against every score, and how much of the work the trees save."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from haulmark.llm import lexical
from haulmark.llm.lexical import SearchConfig
from haulmark.llm.tables import read

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    """(item_id, rank, doc_id, score), every document scored for every item."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item_id, text in items:
        wanted = {
            t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms(text)
        }
        scored = []
        for doc_id, bag, n in bags:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(
                w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m))
                for t, w in wanted.items()
                if t in bag
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda x: x[:3])
        out += [(item_id, i, d, -s) for i, (s, _, _, d) in enumerate(scored[:k], 1)]
    return Counter(out)


def found(frame):
    return Counter(tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect())


@pytest.fixture(scope="module")
def benchmark(spark, sf_dir):
    return read(spark, sf_dir, "benchmark")


@pytest.fixture(scope="module")
def wanted(documents, benchmark):
    return brute(
        [(r["doc_id"], r["text"]) for r in documents.collect()],
        [(r["item_id"], r["text"]) for r in benchmark.collect()],
    )


def test_every_score(documents, benchmark, wanted):
    assert found(lexical.ranked(documents, benchmark)) == wanted


def test_blocks_small_groups_and_no_first_look(documents, benchmark, wanted):
    """Many blocks of items, small groups of documents: the same rows."""
    config = SearchConfig(block_terms=400, first_look=3, cells=20_000, fan=2, item_leaf=2, doc_leaf=3)
    assert found(lexical.ranked(documents, benchmark, config)) == wanted


def test_odd_rows(spark, odd, empty):
    """Nulls, ties, repeated documents and items, items without terms, clashing names."""
    asked = [(1, "The CAT, the dog"), (1, "The CAT, the dog"), (1, "noir chien"), (2, None),
             (3, " ?! "), (None, "one it's 789"), (4, "unknownword"), (5, "word " * 70_000 + "cat")]
    items = spark.createDataFrame(
        [(i, t, 0, "x") for i, t in asked], "item_id bigint, text string, rank int, term string"
    )
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for k in (1, 2, 50):
        assert found(lexical.ranked(odd, items, SearchConfig(k=k))) == brute(docs, asked, k)
    assert lexical.ranked(empty, items).collect() == []
    assert lexical.ranked(odd, items.limit(0)).collect() == []
    assert lexical.ranked(odd, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_colliding_terms(monkeypatch, documents, benchmark, wanted):
    vocabulary = lexical.Vocabulary(["ab", "abc", "ä"])
    points, starts, stops, _ = lexical.term_spans(["AB abc abcd", "Ä ä x"])
    assert vocabulary.find(points, starts, stops).tolist() == [0, 1, -1, -1, 2, -1]
    monkeypatch.setattr(lexical, "span_hashes", lambda p, a, b: np.zeros(len(a), np.uint64))
    twins = lexical.Vocabulary(["ab", "abc", "ä"])
    assert twins.find(points, starts, stops).tolist() == [0, 1, -1, -1, 2, -1]


def test_trees_save_work():
    """On documents of several topics most scores are never worked out, and none is missed."""
    rng = np.random.default_rng(5)
    weight = rng.integers(200, 6_000, 600)
    config = SearchConfig(k=5)
    vectors = [
        np.unique(rng.integers(60 * (i % 10), 60 * (i % 10) + 60, 12)) for i in range(40)
    ]
    n = 4_000
    topic = rng.integers(0, 10, n)
    lists = [np.unique(rng.integers(60 * t, 60 * t + 60, 25)).astype(np.int32) for t in topic]
    flat = np.concatenate(lists)
    offsets = pa.array(np.cumsum([0] + [len(x) for x in lists]).astype(np.int32))
    times = rng.integers(1, 4, len(flat)).astype(np.int32)
    length = rng.integers(30, 900, n)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), pa.array(length), pa.ListArray.from_arrays(offsets, pa.array(flat)),
         pa.ListArray.from_arrays(offsets, pa.array(times))],
        names=["doc_id", "n", "terms", "times"],
    )
    block = lexical.Block(vectors, weight, n, int(length.sum()), None, config)
    best, worked = block.run(iter([batch]))
    table = np.zeros((600, n), np.int64)
    damp = 50 + 50 * length * n // length.sum()
    owner = np.repeat(np.arange(n), [len(x) for x in lists])
    table[flat, owner] = 1_000_000_000 * times.astype(np.int64) // (1000 * times + 20 * damp[owner])
    for vector, (score, ids, _) in zip(vectors, best.found, strict=True):
        full = weight[vector] @ table[vector]
        order = np.lexsort((np.arange(n), -full))[:5]
        assert ids.tolist() == order.tolist() and score.tolist() == full[order].tolist()
    assert worked < 0.15 * n * len(vectors)


def test_numbers_beyond_doubles():
    """Sums that doubles cannot hold are worked out in whole numbers."""
    size = 400
    weight = np.full(size, 2_000_000_000)
    vectors = [np.arange(size), np.arange(1, size)]
    config = SearchConfig(k=1)
    root = lexical.item_tree(vectors, weight, config)
    value = np.arange(999_000, 999_000 + size)
    docs = lexical.document_tree(
        np.array([3]), np.array([False]), np.zeros(size, np.int64), np.arange(size), value, weight, config
    )
    best = lexical.Best(2, 1)
    lexical.search(root, docs, best)
    exact = [sum(2_000_000_000 * int(x) for x in value[a:]) for a in (0, 1)]
    assert [int(s[0]) for s, _, _ in best.found] == exact
