"""Mixing, sharding and fingerprints: built-in functions only."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from haulmark.llm import fingerprints, mixing, sharding
from haulmark.llm.queries import QUERIES
from haulmark.llm.tables import numbered, written


def rows(frame):
    return [r.asDict() for r in frame.collect()]


@pytest.mark.parametrize("name", ["op4_mix_sources", "op5_shards", "op10_fingerprints"])
def test_no_python_in_the_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_numbered(spark):
    frame = written(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")), "t")
    found = rows(numbered(frame, [F.col("x").desc()]))
    assert sorted((999 - r["x"], r["position"]) for r in found) == [(i, i) for i in range(1000)]


# ---- mixing --------------------------------------------------------------------------


def water_fill(sizes):
    """Targets by exhaustive rounds, in exact fractions."""
    from fractions import Fraction

    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        share = {s: Fraction(left * weight[s], open_weight) for s in names if s not in full}
        above = {s for s, t in share.items() if t > 3 * sizes[s]}
        if not above:
            return {s: float(share.get(s, 3 * sizes[s])) for s in names}
        full |= above


def test_mix_targets_and_copies(spark):
    generator = random.Random(4)
    data = []
    for i in range(3000):
        source = generator.choice(["b", "b", "b", "b", "é", "a", None, "Z"])
        if source == "Z" and i % 40:
            source = "b"
        data.append((i, " ".join(["w"] * generator.randint(1, 60)), source))
    frame = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    found = rows(mixing.mix(frame))
    assert len(found) == 3000
    sizes = Counter()
    for _, text, source in data:
        sizes[source] += len(text.split())
    expected = water_fill(sizes)
    taken, largest = Counter(), defaultdict(int)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) and r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 2 * largest[source]
    assert rows(mixing.mix(frame).orderBy("doc_id")) == rows(mixing.mix(frame).orderBy("doc_id"))


def test_mixed_rows_follow_the_copies(spark, odd):
    copies = rows(mixing.mix(odd))
    wanted = Counter()
    for r in copies:
        wanted[r["doc_id"], r["source"]] += r["copies"]
    found = Counter((r["doc_id"], r["source"]) for r in mixing.mixed(odd).collect())
    assert found == +wanted
    assert mixing.mixed(odd).columns == odd.columns


def test_mixed_keeps_columns_of_its_own_names(odd, clashing):
    found = mixing.mixed(clashing)
    assert found.columns == clashing.columns and found.dtypes == clashing.dtypes
    taken = Counter((r["doc_id"], r["source"]) for r in found.collect())
    assert taken == Counter((r["doc_id"], r["source"]) for r in mixing.mixed(odd).collect())
    assert all(r["_key"] == r["_copies"] == r["_copy"] == 5 for r in found.collect())


def test_mix_odd_cases(odd, empty):
    found = rows(mixing.mix(odd))
    assert len(found) == odd.count()
    assert all(r["copies"] == 0 for r in found if r["size"] == 0)
    assert rows(mixing.mix(empty)) == [] and rows(mixing.mixed(empty)) == []
    wordless = odd.filter("doc_id in (3, 4, 5)")
    assert {r["target"] for r in rows(mixing.mix(wordless))} == {0.0}


# ---- sharding ------------------------------------------------------------------------


def jump(key, shards):
    at, to = -1, 0
    while to < shards:
        at = to
        drawn = int(hashlib.md5(f"{key}:{at}".encode()).hexdigest()[:8], 16) + 1
        to = (at + 1) * 2**32 // drawn
    return at


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 200])
def test_shard_of_is_jump_hash(spark, shards):
    frame = spark.range(300).select(F.col("id").cast("string").alias("k"))
    found = frame.select("k", sharding.shard_of(F.col("k"), shards).alias("s")).collect()
    assert all(r["s"] == jump(r["k"], shards) for r in found)


def test_growth_moves_rows_only_into_the_new_shard(spark):
    frame = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = rows(sharding.shards(frame))
    moved = [r for r in found if r["shard"] != r["grown_shard"]]
    assert all(r["grown_shard"] == 8 for r in moved)
    assert 4000 / 9 * 0.8 < len(moved) < 4000 / 9 * 1.2
    assert max(Counter(r["shard"] for r in found).values()) < 1.2 * 500


def test_shards_odd_cases(odd, empty):
    found = rows(sharding.shards(odd))
    texts = [r["text"] or "" for r in odd.collect()]
    assert sorted(r["text_crc32"] for r in found) == sorted(zlib.crc32(t.encode()) for t in texts)
    assert sorted(r["size"] for r in found) == sorted(len(t.encode()) + 1 for t in texts)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert rows(sharding.shards(empty)) == []


# ---- fingerprints --------------------------------------------------------------------


def test_edited_text_and_neighbours(spark):
    generator = random.Random(1)
    data = [
        (i, "".join(generator.choice("ab é\U0001f600\n") for _ in range(generator.randint(0, 40))))
        for i in generator.sample(range(5000), 300)
    ]
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in rows(fingerprints.fingerprints(frame))}
    ordered = sorted(data, reverse=True)
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in found.values()}
    for (i, text), (j, other) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        changed = text[: len(text) - half] + other[:half]
        assert found[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert found[i]["n_chars"] == len(text)
        assert found[i]["near_next"] == 1 - (prints[i] ^ prints[j]).bit_count() / 64
        both = prints[i] ^ int(found[i]["edited_fingerprint"], 16)
        assert found[i]["near_edited"] == 1 - both.bit_count() / 64
    by_text = defaultdict(set)
    for i, text in data:
        by_text[text].add(prints[i])
    assert all(len(p) == 1 for p in by_text.values())


def test_votes_of_terms(spark):
    text = "a b c d e f g h a b c d e"
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    hashes = frame.select(fingerprints.word_hashes(F.col("text")).alias("w"))
    terms = hashes.select(F.explode(fingerprints.runs(F.col("w")))).collect()
    assert len(terms) == 9  # of which a b c d e is one, twice
    expected = 0
    for bit in range(64):
        votes = sum(1 if (t[0] >> bit) & 1 else -1 for t in terms)
        expected |= (votes > 0) << bit
    found = fingerprints.simhash(frame, ["doc_id"]).first()["fingerprint"]
    assert found % 2**64 == expected


def test_near_copies_are_nearer_than_others(documents):
    found = rows(fingerprints.fingerprints(documents))
    edited = [r["near_edited"] for r in found if r["n_chars"] > 200]
    following = [r["near_next"] for r in found if r["n_chars"] > 200]
    assert sum(edited) / len(edited) > 0.62
    assert sum(following) / len(following) < 0.58


def test_block_tables_find_all_within_the_radius(spark):
    generator = random.Random(5)
    base = [generator.getrandbits(64) for _ in range(60)]
    values = set(base)
    for b in base:
        for n in (1, 2, 3, 4, 5):
            values.add(b ^ sum(1 << p for p in generator.sample(range(64), n)))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    found = {(r["query"], r["found"]) for r in fingerprints.within(frame, frame).collect()}
    mask = 2**64 - 1
    expected = {
        (a, b) for a in signed for b in signed if ((a ^ b) & mask).bit_count() <= 3
    }
    assert found == expected
    assert fingerprints.within(frame, frame).count() == len(expected)
    with pytest.raises(ValueError):
        fingerprints.within(frame, frame, 4)


def test_fingerprints_odd_cases(spark, odd, empty):
    found = rows(fingerprints.with_neighbours(fingerprints.fingerprints(odd)))
    assert len(found) == odd.count()
    assert sum(r["n_chars"] == 0 for r in found) == 3
    assert all(
        r["fingerprint"] == "0" * 16 for r in found if r["n_chars"] == 0 or r["n_chars"] == 3 and r["doc_id"] == 5
    )
    assert [r["n_near"] for r in found if r["doc_id"] == 50] == [1]
    assert rows(fingerprints.with_neighbours(fingerprints.fingerprints(empty))) == []
    one = odd.filter("doc_id = 50")
    assert [r["near_next"] for r in rows(fingerprints.fingerprints(one))] == [1.0]
