"""Periodic runs against a search by every lag of every document."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from haulmark.llm import runs

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(words, least=24, periods=3):
    """Every lag, every stretch; a stretch counts at the smallest lag only."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    at = np.array([number[w] for w in words], np.int64)
    n, found, seen = len(words), [], set()
    for q in range(1, n // periods + 1):
        same = np.concatenate([[False], at[:-q] == at[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = b - a + q
            if length >= max(least, periods * q) and (a, length) not in seen:
                seen.add((a, length))
                found.append((a, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plant(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def brute_report(doc_id, text):
    words = plant(doc_id, WORD.findall(text or ""))
    found = brute_runs(words)
    kept = np.ones(len(words), bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in found)
    plain = " ".join(w for w, k in zip(words, kept, strict=True) if k)
    return (
        doc_id,
        len(found),
        *best,
        best[0] is not None and 1000 * best[1] // best[2] or None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(plain.encode()).hexdigest(),
    )


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_report_is_that_of_every_lag(request, table):
    docs = request.getfixturevalue(table)
    rows = [r for r in docs.collect() if len(r["text"] or "") < 60_000 or table == "odd"]
    known = {}
    wanted = []
    for r in rows:
        text = r["text"]
        if text not in known and len(text or "") > 100_000:
            continue  # one word 60,000 times: below
        wanted.append(brute_report(r["doc_id"], text))
    found = [tuple(r) for r in runs.run_report(docs).collect()]
    assert len(found) == docs.count()
    missing = set(wanted) - set(found)
    assert not missing
    assert any(r[1] > 0 for r in found)


def found_in(words):
    _, starts, stops, bounds = runs.words([" ".join(words)])
    points = runs.codes([" ".join(words)])[0]
    return runs.find_runs(runs.word_numbers(points, starts, stops), bounds)[0]


def test_random_words_of_few_kinds():
    """Two or three kinds of words make runs within runs, next to each other, overlapping."""
    rng = np.random.default_rng(1)
    for n in range(120):
        kinds = int(rng.integers(1, 4))
        words = [f"w{k}" for k in rng.integers(0, kinds, int(rng.integers(1, 90)))]
        for _ in range(int(rng.integers(1, 4))):
            a = int(rng.integers(0, len(words)))
            unit = words[a : a + int(rng.integers(1, 70))]
            words[a:a] = unit * int(rng.integers(1, 6)) + unit[: int(rng.integers(0, len(unit)))]
        assert found_in(words) == brute_runs(words), n


def test_periods_whose_parts_recur():
    """Each part of the period occurs more than once within it, also in longer grams."""
    a, b, c = ([f"{x}{i}" for i in range(20)] for x in "abc")
    for unit in (a + b + a + a, a + a + b + b, a + b + a + c, a * 2 + b, a + b + a + b + a):
        for times in (3, 4, 7):
            words = ["x", "y"] + unit * times + unit[:5] + ["z"] * 30
            assert found_in(words) == brute_runs(words)


def test_one_word_throughout(spark):
    long = "word " * 60_000 + "end"
    frame = spark.createDataFrame([(7, long), (7, long), (8, "")], "doc_id long, text string")
    found = runs.periodic_runs(frame, ["doc_id"]).collect()
    assert [tuple(r["runs"][0]) for r in found if r["doc_id"] == 7] == [(0, 60_000, 1)] * 2
    assert [r["collapsed"] for r in found if r["doc_id"] == 7] == ["word end"] * 2


def test_colliding_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(runs, "span_hashes", lambda p, a, b: (b - a).astype(np.uint64))
    words = "ab cd ab cd ef ab".split() * 9
    assert found_in(words) == brute_runs(words)


def test_names_and_empty(odd, empty):
    clash = odd.withColumn("runs", odd["position"]).withColumn("collapsed", odd["key"])
    found = runs.periodic_runs(clash, clash.columns)
    assert found.columns == [*clash.columns, "n_words", "runs_", "collapsed_"]
    assert found.count() == odd.count()
    assert runs.run_report(empty).collect() == []


def test_configuration():
    assert runs.RunConfig().seed == 16
    with pytest.raises(ValueError, match="three periods"):
        runs.RunConfig(periods=2)
