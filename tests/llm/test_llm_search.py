"""Near duplicates, exact top-k, the pipeline, and queries next to their SQL."""

import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulmark.llm import near_dups, topk
from haulmark.llm.oracle import ORACLE
from haulmark.llm.queries import QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from check import compare, connect  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings"]


def rows(frame):
    return [r.asDict() for r in frame.collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = connect(SMALL)
    for table in TABLES:
        con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    assert compare(QUERIES[name](spark, SMALL), con, ORACLE[name]) == ""


# ---- near duplicates -----------------------------------------------------------------


def counted(text):
    words = text.lower().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def alike(x, y):
    """Probability Jaccard by its definition."""
    return sum(
        1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x.keys() | y.keys())
        for i in x.keys() & y.keys()
    )


def brute_classes(texts):
    """Smallest id of each component, all pairs compared."""
    bags = {i: counted(t or "") for i, t in texts.items()}
    parent = {i: i for i in texts}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            if bags[i].keys() & bags[j].keys() and alike(bags[i], bags[j]) >= 0.8:
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: top(i) for i in ids}


def test_classes_of_the_documents(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    found = {r["doc_id"]: r["class_id"] for r in rows(near_dups.near_duplicates(documents))}
    assert found == brute_classes(texts)


def test_chains_and_groups(spark):
    """Links that do not touch a bucket's first node: chains, and two groups side by side."""
    words = [f"w{i}" for i in range(120)]

    def changed(n, mark):
        return " ".join(words[:-n] + [f"{mark}{k}" for k in range(n)]) if n else " ".join(words)

    texts = {i: changed(4 * i, "x") for i in range(9)}  # neighbours alike, ends not
    texts |= {100 + i: changed(15, f"g{i}a") for i in range(12)}
    texts |= {200 + i: changed(i, f"h{i}b") for i in range(8)}
    texts |= {300: changed(0, "").upper(), 301: changed(0, "").replace(" ", "\n\t")}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r["doc_id"]: r["class_id"] for r in rows(near_dups.near_duplicates(frame))}
    assert found == brute_classes(texts)


def test_signature_agreement_is_the_similarity():
    config = near_dups.DedupConfig(bands=400)
    a = "a b c d e f " * 20 + "x y z"
    b = "a b c d e f " * 10 + "x y z q"
    signature = near_dups.signatures([a, b, ""], config)
    element, count, owner = near_dups.weighted([a, b], 5)
    cut = int(np.searchsorted(owner, 1))
    exact = near_dups.similarity(element[:cut], count[:cut], element[cut:], count[cut:])
    assert exact == pytest.approx(alike(counted(a), counted(b)))
    assert (signature[0] == signature[1]).mean() == pytest.approx(exact, abs=0.04)
    assert not signature[2].any()


def test_components_of_a_long_path(spark):
    path = [(f"{i:04d}".encode(), f"{i + 1:04d}".encode()) for i in range(60)]
    edges = spark.createDataFrame([*path, (b"z1", b"z2")], "a binary, b binary")
    found = {bytes(r["node"]): bytes(r["label"]) for r in near_dups.components(edges).collect()}
    assert {found[n] for n in found if n[:1] != b"z"} == {b"0000"}
    assert found[b"z2"] == b"z1" and len(found) == 63


def test_near_duplicates_odd_cases(odd, empty):
    found = rows(near_dups.near_duplicates(odd))
    assert len(found) == odd.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append((r["class_id"], r["class_size"]))
    assert by_id[1] == [(1, 3), (1, 3)] and by_id[2] == [(1, 3)]
    assert by_id[3] == [(3, 1)] and by_id[4] == [(4, 1)] and by_id[5] == [(5, 1)]
    kept = rows(near_dups.deduplicated(odd))
    assert Counter(r["doc_id"] for r in kept) == {
        1: 1, 3: 1, 4: 1, 5: 1, 7: 1, 8: 1, 50: 1, 51: 1, None: 2
    }
    assert near_dups.deduplicated(odd).columns == odd.columns
    assert rows(near_dups.near_duplicates(empty)) == []
    assert rows(near_dups.deduplicated(empty)) == []


def test_deduplicated_keeps_columns_of_its_own_names(clashing):
    kept = near_dups.deduplicated(clashing)
    assert kept.columns == clashing.columns and kept.count() == 10
    assert all(r["_id"] == r["_mark"] == r["_rows"] == 5 for r in kept.collect())


def test_links_of_a_group_span_it():
    """Any number of alike pairs of one group leave as one link fewer than labels."""
    label = np.array([0, 1, 1, 2, 3, 4])
    found = [(i, j) for i in range(5) for j in range(5) if label[i] != label[j]]
    kept = near_dups.spanning(found, label)
    assert len(kept) == 3 and set(kept) <= set(found)
    assert near_dups.spanning([], np.zeros(0, np.int64)) == []


def test_large_buckets(spark):
    """Buckets beyond a block: chains of classes across blocks are all found."""
    base = [f"w{i}" for i in range(100)]
    texts = {}
    for i in range(90):  # three groups that share much text, but less than the threshold
        words = list(base)
        for k in range(10):
            words[(i % 3) * 30 + k * 2] = f"g{i % 3}{k}"
        words[95] = f"own{i}"
        texts[i] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    config = near_dups.DedupConfig(pair_members=4, block_members=16, bands=60, rows=2)
    found = {r["doc_id"]: r["class_id"] for r in rows(near_dups.near_duplicates(frame, config))}
    assert found == brute_classes(texts)


# ---- exact top-k ---------------------------------------------------------------------


def brute_top(vectors, k):
    usable = {
        i: np.floor(np.array(v, float) * 256)
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    width = max((len(v) for v in usable.values()), default=0)
    usable = {i: np.pad(v, (0, width - len(v))) for i, v in usable.items()}
    out = []
    for q, own in usable.items():
        if q % 50 == 0:
            scores = sorted((-int(own @ v), i) for i, v in usable.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("clustered", [False, True])
def test_top_k_against_all_pairs(spark, clustered):
    generator = np.random.default_rng(8)
    centres = generator.normal(size=(6, 16))
    vectors = []
    for i in range(700):
        v = generator.normal(size=16) * (0.02 if clustered else 1)
        vectors.append((i, (v + centres[i % 6] * clustered).tolist()))
    vectors += [(701, vectors[5][1]), (702, vectors[5][1])]  # ties
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    config = topk.TopKConfig(candidate_rows=100, query_rows=4)
    found = sorted(tuple(r) for r in topk.top_k(frame, config).collect())
    assert found == brute_top(vectors, 5)


def test_pivots_eliminate_candidates():
    generator = np.random.default_rng(2)
    centres = generator.normal(size=(20, 8)) * 2000
    data = np.floor(np.repeat(centres, 50, axis=0) + generator.normal(size=(1000, 8)) * 20)
    pivots = data[::50]
    table, squares = topk._distances(data, pivots), (data * data).sum(1)
    ids = np.arange(1000)
    n = 0
    for q in range(0, 1000, 100):
        best, score, seen = topk.search(
            data[q], q, table[q], ids, data, squares, table, topk.TopKConfig()
        )
        others = np.delete(ids, q)
        exact = (data[others] @ data[q]).astype(int)
        order = np.lexsort((others, -exact))[:5]
        assert best.tolist() == others[order].tolist() and score.tolist() == exact[order].tolist()
        n += seen
    assert n < 10 * 1000 / 2


@pytest.mark.parametrize("scale", [1.0, 1e-3, 3e4])
def test_joint_bounds_hold_and_beat_each_pivot(scale):
    generator = np.random.default_rng(5)
    data = np.floor(generator.normal(size=(400, 24)) * 256 * scale)
    data[7], data[8], data[9] = 0, data[3], data[3] * 2
    data[10:20] *= 50  # some vectors far longer than the pivots
    pivots = topk.orthogonal(data[[3, 8, 7, 9, *range(30, 44)]])
    axes = pivots / np.sqrt((pivots[0] ** 2).sum())
    assert len(pivots) == 15 and np.allclose(axes @ axes.T, np.eye(15))
    table, squares = topk._distances(data, pivots), (data * data).sum(1)
    placed = topk.places(squares, table, float(np.sqrt((pivots[0] ** 2).sum())))
    rounding = 1 + 1e-8 * (squares[:, None] + squares[None, :])
    scores = data @ data.T
    joint = placed @ placed.T + rounding
    assert (joint >= scores).all()
    for q in range(0, 400, 40):
        low = np.abs(table - table[q]).max(axis=1)
        single = (squares[q] + squares - low * low) / 2
        assert (joint[q] <= single + 2 * rounding[q] + 1e-3 * np.sqrt(squares[q] * squares)).all()


def test_no_direction_no_pivot():
    assert topk.orthogonal(np.zeros((3, 4))).shape == (0, 4)
    assert topk.orthogonal(np.zeros((0, 4))).shape == (0, 4)
    placed = topk.places(np.array([4.0, 9.0]), np.zeros((2, 0)), 0.0)
    assert np.allclose(placed[:, 0], [2, 3], atol=1e-6)


def test_share_of_given_vectors_evaluated(spark):
    """Unstructured vectors of 64 components: less than half are evaluated."""
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = frame.select("vec_id", "embedding").toPandas()
    data = np.floor(np.array(found["embedding"].tolist(), float) * 256)
    ids = found["vec_id"].to_numpy()
    pivots = topk.orthogonal(data[:: len(data) // 48][:48])
    table, squares = topk._distances(data, pivots), (data * data).sum(1)
    placed = topk.places(squares, table, float(np.sqrt((pivots[0] ** 2).sum())))
    config, seen = topk.TopKConfig(), 0
    queries = np.flatnonzero(ids % 50 == 0)
    for q in queries:
        *_, n = topk.search(
            data[q], ids[q], table[q], ids, data, squares, table, config, placed @ placed[q]
        )
        seen += n
    share = seen / (len(queries) * len(data))
    print(f"evaluated share {share:.3f}")
    assert share < 0.3


def test_a_third_of_all_rows_equal(spark):
    """Copies of one row are candidates each, but only as many as can rank are kept."""
    generator = np.random.default_rng(4)
    vectors = [(i, generator.normal(size=6).tolist()) for i in range(200)]
    copies = [(7, vectors[0][1])] * 300
    frame = spark.createDataFrame(vectors + copies, "vec_id bigint, embedding array<double>")
    found = topk.top_k(frame, topk.TopKConfig(candidate_rows=256))
    found = found.select("query_id", "vec_id", "score").collect()
    whole = [(i, np.floor(np.array(v) * 256)) for i, v in vectors + copies]
    expected = []
    for q in range(0, 200, 50):
        own = whole[q][1]
        scores = sorted((-int(own @ v), i) for i, v in whole if i != q)
        expected += [(q, i, -s) for s, i in scores[:5]]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert sum(i == 7 for _, i, _ in expected) >= 3  # copies that rank beside each other


def test_top_k_odd_cases(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [0.5]), (1, []), (2, None), (3, [None, 1.0]),
        (4, [nan, 1.0]), (5, [inf]), (None, [1.0]), (6, [-1.0, 0.001, 3.0]), (7, [0.0, 0.0]),
    ]
    schema = "vec_id bigint, embedding array<float>, label int, score double, rank int"
    frame = spark.createDataFrame([(*r, 1, 2.0, 3) for r in data], schema)
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in topk.top_k(frame).collect()}
    assert found[0, 50] == 256 * 128 and found[0, 1] == 0 and found[50, 6] == -256 * 128
    assert {i for _, i in found} == {0, 50, 1, 6, 7}
    assert rows(topk.top_k(frame.limit(0))) == []
    huge = spark.createDataFrame(
        [(0, [1e150, 1.0]), (1, [1e150, 2.0]), (2, [-1e150, 0.0]), (3, [0.0, 9.0])],
        "vec_id bigint, embedding array<double>",
    )
    assert [r["vec_id"] for r in topk.top_k(huge).orderBy("rank").collect()] == [1, 3, 2]


# ---- pipeline ------------------------------------------------------------------------


def test_stages_take_effect(spark, documents):
    docs, left = documents, [documents.count()]
    from haulmark.llm.tables import written

    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SMALL), name)
        if name != "pieces":
            assert out.columns == documents.columns
        if name == "near_duplicates":
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert sorted(r["doc_id"] for r in out.collect()) == sorted(
                set(brute_classes(texts).values())
            )
        docs = out
        left.append(docs.count())
    assert left[0] >= left[1] >= left[2] > left[3]
    assert docs.filter(~F.col("same")).count() == 0
    run = corpus_pipeline.run(spark, SMALL)
    assert run.count() == left[-1] and run.columns == docs.columns


def test_clean_documents_stay(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    docs = corpus_pipeline.keep_languages(spark, documents, SMALL)
    docs = corpus_pipeline.keep_quality(spark, docs, SMALL)
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len(good - kept) <= 0.03 * len(good)


def test_pipeline_odd_cases(spark, odd, clashing, empty):
    for docs, n in ((odd, None), (clashing, None), (empty, 0)):
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SMALL)
            assert n is None or found.count() == n
            assert set(docs.columns) <= set(found.columns)
            found.count()


def test_large_buckets_are_compared_in_blocks(spark):
    """Many copies of one text with edits of their own: few are alike to the first of all."""
    import random

    generator = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    texts = {}
    for i in range(90):
        words = list(base)
        for place in generator.sample(range(80), generator.randint(0, 3)):
            words[place] = f"e{generator.randint(0, 40)}"
        texts[i] = " ".join(words * (1 + (i % 9 == 0)))
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    expected = brute_classes(texts)
    assert len(set(expected.values())) > 5
    for config in (
        near_dups.DedupConfig(pair_members=2, block_members=7),
        near_dups.DedupConfig(),
    ):
        found = rows(near_dups.near_duplicates(frame, config))
        assert {r["doc_id"]: r["class_id"] for r in found} == expected


def test_documents_without_an_id(spark):
    words = [f"w{i}" for i in range(60)]
    data = [(None, " ".join(words)), (None, " ".join(words[:-2] + ["x", "y"])), (3, "other text")]
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    found = sorted(r["class_size"] for r in rows(near_dups.near_duplicates(frame)))
    assert found == [1, 2, 2]
    assert near_dups.deduplicated(frame).count() == 2
