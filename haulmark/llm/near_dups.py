"""Near-duplicate documents: ProbMinHash of weighted word shingles, banding, verification.

A document is the multiset of its runs of five words. Two documents are alike by their
probability Jaccard, which does not depend on length and equals the Jaccard index where all
counts are the same. Each shingle sends a Poisson process of arrivals, at the rate of its
count, to random components of the signature; a component keeps the shingle that arrived
first, so two signatures agree in a component with that probability. A shingle stops as soon
as its next arrival is later than every first one.

Documents of equal words are one node. Nodes that agree in a band of the signature meet in a
bucket; pairs are verified on their whole texts. Classes are the connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.tables import fresh, remove, slices, written
from haulmark.llm.text import codes, groups, mix64, owners, span_hashes, spans

_WHITE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class DedupConfig:
    words: int = 5
    similarity: float = 0.8
    bands: int = 25  # a pair at 0.8 misses all bands with probability 5e-5
    rows: int = 5
    pair_members: int = 48  # a bucket of more is compared in blocks, not pair by pair
    block_members: int = 256


def normal(text: Column) -> Column:
    """Lower case, one space between words; null if there is no word."""
    plain = F.btrim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    return F.when(F.length(plain) > 0, plain)


def content_key(plain: Column) -> Column:
    return F.unhex(F.md5(plain))


def has_words(text: Column) -> Column:
    """The same as a normal form that is not null, without making it."""
    return F.coalesce(F.length(F.btrim(text, F.lit(_WHITE))) > 0, F.lit(False))


def shingles(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of words and the text it is in; shorter texts are one run."""
    points, text_starts = codes(texts)
    starts, stops = spans(points != 32)
    hashed, owner = span_hashes(points, starts, stops), owners(starts, text_starts)
    n = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(n) - n
    runs = np.zeros(len(hashed), np.uint64)
    for k in range(words):
        shifted = np.zeros_like(hashed)
        if k < len(hashed):
            shifted[: len(hashed) - k] = hashed[k:]
        runs = mix64(runs * np.uint64(31) + shifted)
    place = np.arange(len(hashed)) - first[owner]
    whole = place + words <= n[owner]
    runs, of = runs[whole], owner[whole]
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        extra = np.array(
            [np.bitwise_xor.reduce(mix64(hashed[first[i] : first[i] + n[i]] + np.arange(n[i], dtype=np.uint64))) for i in short],
            np.uint64,
        )
        runs, of = np.concatenate([runs, extra]), np.concatenate([of, short])
    return runs, of


def weighted(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles in order of (text, hash): hash, count, text.

    The upper bits of the sort key are the text's number, so one sort serves all; 44 bits of
    the hash are left to tell the shingles of one text apart.
    """
    runs, of = shingles(texts, words)
    key = np.sort((of.astype(np.uint64) << np.uint64(44)) | (runs >> np.uint64(20)))
    if not len(key):
        return key, np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(begins, len(key)))
    key = key[begins]
    return key & np.uint64((1 << 44) - 1), count, (key >> np.uint64(44)).astype(np.int64)


def signatures(texts: list[str], config: DedupConfig) -> np.ndarray:
    """texts x components: the shingle that arrived first; 0 in texts without words."""
    m = config.bands * config.rows
    element, count, owner = weighted(texts, config.words)
    arrival = np.full(len(texts) * m, np.inf)
    winner = np.zeros(len(texts) * m, np.uint64)
    rate, time = 1.0 / count, np.zeros(len(element))
    turn = 0
    while len(element):
        turn += 1
        drawn = mix64(element * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn))
        uniform = ((drawn >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)
        time = time - np.log(uniform) * rate
        at = owner * m + (mix64(drawn) % np.uint64(m)).astype(np.int64)
        np.minimum.at(arrival, at, time)
        won = time == arrival[at]
        winner[at[won]] = element[won]
        latest = arrival.reshape(-1, m).max(axis=1)
        going = time < latest[owner]
        element, owner, time, rate = element[going], owner[going], time[going], rate[going]
    return winner.reshape(-1, m)


def band_keys(signature: np.ndarray, config: DedupConfig) -> np.ndarray:
    """texts x bands: one number for the components of each band."""
    parts = signature.reshape(len(signature), config.bands, config.rows)
    keys = np.broadcast_to(np.arange(1, config.bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(config.rows):
        keys = mix64(keys * np.uint64(31) + parts[:, :, i])
    return keys.view(np.int64)


def similarity(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Probability Jaccard of two sets of hashes (ascending) with their counts.

    A common element is the first arrival in both with probability x / sum(max(x_j, y_j / r)),
    r being the ratio of its counts; elements of one ratio share that sum.
    """
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = b[at] == a if len(b) else np.zeros(len(a), bool)
    if not common.any():
        return 0.0
    left, right = x[common].astype(float), y[at[common]].astype(float)
    only_left = float(x[~common].sum())
    only_right = float(y.sum() - y[at[common]].sum())
    total, ratio = 0.0, right / left
    for r in np.unique(ratio):
        top = np.maximum(left, right / r).sum() + only_left + only_right / r
        total += float(left[ratio == r].sum()) / top
    return total


def _sign(docs: DataFrame, config: DedupConfig) -> DataFrame:
    """doc_id, mark, key, bands of every document that has words.

    With doc_id the mark, a plain hash of the text, finds the row again without making its
    normal form.
    """
    mark, plain = F.xxhash64("text").alias("mark"), normal(F.col("text")).alias("plain")
    normalised = docs.filter(has_words(F.col("text"))).select("doc_id", mark, plain)
    rows = normalised.select("doc_id", "mark", content_key(F.col("plain")).alias("key"), "plain")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            parts = [
                band_keys(signatures(group, config), config)
                for _, group in groups(batch.column("plain").to_pylist())
            ]
            keys = np.concatenate(parts) if parts else np.zeros((0, config.bands), np.int64)
            offsets = np.arange(0, keys.size + 1, config.bands, dtype=np.int32)
            bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), batch.column("key"), bands],
                names=["doc_id", "mark", "key", "bands"],
            )

    return rows.mapInArrow(sign, f"doc_id {kind}, mark bigint, key binary, bands array<bigint>")


def _verified(pairs: DataFrame, texts: DataFrame, config: DedupConfig) -> DataFrame:
    """The pairs (a, b) that are alike, verified on both whole texts."""
    both = (
        pairs.join(texts.select(F.col("key").alias("a"), F.col("plain").alias("_one")), "a")
        .join(texts.select(F.col("key").alias("b"), F.col("plain").alias("_other")), "b")
        .select("a", "b", "_one", "_other")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = []
            one, other = batch.column("_one").to_pylist(), batch.column("_other").to_pylist()
            woven = [text for pair in zip(one, other, strict=True) for text in pair]
            # Groups of texts, an even number each, so that a pair stays together.
            for start in range(0, len(woven), 256):
                part = woven[start : start + 256]
                element, count, owner = weighted(part, config.words)
                bounds = np.searchsorted(owner, np.arange(len(part) + 1))
                for i in range(0, len(part), 2):
                    p, q, r = bounds[i : i + 3]
                    alike = similarity(element[p:q], count[p:q], element[q:r], count[q:r])
                    kept.append(alike >= config.similarity)
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"]
            )

    return both.mapInArrow(compare, "a binary, b binary")


def _common(
    element: np.ndarray, share: np.ndarray, owner: np.ndarray, one: np.ndarray, other: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text of ``one`` and of ``other``: number of common elements, and the share of
    each text's weight that they hold. Only elements of several texts matter; their columns
    are multiplied a few thousand at a time, so memory is bounded however long texts are.
    """
    known, column, times = np.unique(element, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    wanted = shared[column]
    column, owner, share = number[column[wanted]], owner[wanted], share[wanted]
    order = np.argsort(column, kind="stable")
    column, owner, share = column[order], owner[order], share[order]
    shape, n = (len(one), len(other)), int(max(one.max(), other.max())) + 1
    inter, left, right = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    for start in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        has, weight = np.zeros((n, 4096), np.float32), np.zeros((n, 4096), np.float32)
        has[owner[a:b], column[a:b] - start] = 1
        weight[owner[a:b], column[a:b] - start] = share[a:b]
        inter += has[one] @ has[other].T
        left += weight[one] @ has[other].T
        right += has[one] @ weight[other].T
    return inter, left, right


def links_between(
    texts: list[str], label: np.ndarray, one: np.ndarray, other: np.ndarray, config: DedupConfig
) -> list[tuple[int, int]]:
    """Pairs of a text of ``one`` and one of ``other`` that are alike and differ in label.

    The weight that common elements hold in either text bounds the similarity from above.
    Where no shingle repeats it is the Jaccard index, known from the number of common ones;
    other pairs within the bound are compared one by one.
    """
    element, count, owner = weighted(texts, config.words)
    if not len(element):
        return []
    size = np.bincount(owner, minlength=len(texts))
    total = np.bincount(owner, count, len(texts))
    inter, left, right = _common(element, count / total[owner], owner, one, other)
    plain = size == total
    both = plain[one][:, None] & plain[other][None, :]
    union = size[one][:, None] + size[other][None, :] - inter
    jaccard = inter / np.maximum(union, 1)
    differ = label[one][:, None] != label[other][None, :]
    alike = differ & both & (jaccard >= config.similarity)
    found = [(int(one[i]), int(other[j])) for i, j in np.argwhere(alike)]
    near = differ & ~both & (np.minimum(left, right) >= config.similarity - 1e-3)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, j in np.argwhere(near):
        x, y = int(one[i]), int(other[j])
        a, b = slice(bounds[x], bounds[x + 1]), slice(bounds[y], bounds[y + 1])
        if similarity(element[a], count[a], element[b], count[b]) >= config.similarity:
            found.append((x, y))
    return found


def spanning(found: list[tuple[int, int]], label: np.ndarray) -> list[tuple[int, int]]:
    """As few of the links as hold the same labels together."""
    parent = list(range(int(label.max(initial=-1)) + 1))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, j in found:
        x, y = top(int(label[i])), top(int(label[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((i, j))
    return kept


def _in_blocks(
    members: DataFrame, texts: DataFrame, config: DedupConfig, own_only: bool
) -> DataFrame:
    """Links (a, b) between members (bucket, node, label) of different classes in a bucket.

    A bucket is cut into blocks by a hash; two blocks of a bucket, or (``own_only``) one with
    itself, are a group of bounded size. From a group come the links that join its labels, one
    fewer than labels at most, not all that were found.
    """
    sizes = members.groupBy("bucket").agg(
        F.ceil(F.count("*") / config.block_members).cast("int").alias("_blocks")
    )
    own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda x: x != F.col("_own"))
    meets = F.array(F.col("_own")) if own_only else others
    placed = (
        members.join(sizes, "bucket")
        .withColumn("_own", own)
        .join(texts.withColumnRenamed("key", "node"), "node")
        .withColumn("_with", F.explode(meets))
        .select(
            "bucket",
            F.least("_own", "_with").alias("_first"),
            F.greatest("_own", "_with").alias("_second"),
            "_own",
            "node",
            "label",
            "plain",
        )
    )

    def compare(group: pa.Table) -> pa.Table:
        nodes, labels = group["node"].to_pylist(), group["label"].to_pylist()
        names = {name: i for i, name in enumerate(sorted(set(labels)))}
        label = np.array([names[name] for name in labels])
        own = np.asarray(group["_own"].combine_chunks())
        first, second = group["_first"][0].as_py(), group["_second"][0].as_py()
        one, other = np.flatnonzero(own == first), np.flatnonzero(own == second)
        found = []
        if len(names) > 1 and len(one) and len(other):
            found = links_between(group["plain"].to_pylist(), label, one, other, config)
            found = spanning(found, label)
        ends = [sorted((nodes[i], nodes[j])) for i, j in found]
        return pa.table(
            {
                "a": pa.array([x for x, _ in ends], pa.binary()),
                "b": pa.array([y for _, y in ends], pa.binary()),
            }
        )

    return placed.groupBy("bucket", "_first", "_second").applyInArrow(compare, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of each node's connected component.

    Each round a node takes the smallest label around it, then the label of that label, so
    long paths shrink fast. Every round is written, and the one before it removed; only a
    count of changes is collected.
    """
    both = written(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        ),
        "edges",
    )
    found = written(
        both.groupBy("node").agg(F.min("other").alias("label")).select(
            "node", F.lit(None).cast(edges.schema["a"].dataType).alias("_old"), F.least("node", "label").alias("label")
        ),
        "labels",
    )
    while True:
        labels = found.select("node", "label")
        around = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("_near"))
        )
        nearer = labels.join(around, "node").select(
            "node", F.col("label").alias("_old"), F.least("label", "_near").alias("label")
        )
        jumped = (
            nearer.join(
                labels.select(F.col("node").alias("label"), F.col("label").alias("_far")), "label"
            )
            .select("node", "_old", F.least("label", "_far").alias("label"))
        )
        before, found = found, written(jumped, "labels")
        remove(before)
        if found.filter(F.col("label") != F.col("_old")).limit(1).count() == 0:
            remove(both)
            return found.select("node", "label")


def joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (node, label), a written table, with the classes that links (a, b) join made
    one. Only links between classes count, one for each two of them, so components are those of
    a small graph of classes, not of all links found so far."""
    first = labels.select(F.col("node").alias("a"), F.col("label").alias("_one"))
    second = labels.select(F.col("node").alias("b"), F.col("label").alias("_other"))
    ends = (
        links.join(first, "a")
        .join(second, "b")
        .filter(F.col("_one") != F.col("_other"))
        .select(F.least("_one", "_other").alias("a"), F.greatest("_one", "_other").alias("b"))
        .distinct()
    )
    between = written(ends, "between")
    if between.limit(1).count() == 0:
        remove(between)
        return labels
    classes = components(between).select(F.col("node").alias("label"), F.col("label").alias("_new"))
    renamed = labels.join(classes, "label", "left").select(
        "node", F.coalesce("_new", "label").alias("label")
    )
    found = written(renamed, "labels")
    remove(labels, between)
    return found


def _classes(docs: DataFrame, config: DedupConfig) -> tuple[DataFrame, DataFrame]:
    """The signed documents, and node, class_key of each node that has a candidate.

    First every node is compared with one other, the smallest of those it shares a bucket
    with; this joins most copies by one link a node. Then, in each bucket that still holds
    several classes, the smallest node is compared with those of other classes, then the
    largest, and at last all pairs of different classes that are left; in large buckets in
    blocks, inside tasks. So no pair of a bucket is passed over unless its two are in one class
    already, and a group of copies that falls into one class costs a comparison per member
    and not per pair.
    """
    signed = written(_sign(docs, config), "signed")
    members = signed.select(F.explode("bands").alias("bucket"), F.col("key").alias("node"))
    members = members.groupBy("bucket", "node").agg(F.min(F.lit(1)).alias("_1")).drop("_1")
    held = written(members, "members")
    sizes = held.groupBy("bucket").agg(
        F.min("node").alias("low"), F.max("node").alias("high")
    )
    shared = written(
        held.join(sizes.filter(F.col("low") != F.col("high")), "bucket"), "shared"
    )
    remove(held)
    # Of each node the smallest other one that is the first of a bucket; a node that is itself
    # the first of all its buckets has none.
    first_of = F.min(F.when(F.col("node") != F.col("low"), F.col("low"))).alias("first")
    nearest = written(shared.groupBy("node").agg(first_of), "nearest")
    firsts = signed.groupBy("key").agg(
        F.min("doc_id").alias("_id"),
        F.coalesce(F.min_by("mark", "doc_id"), F.min("mark")).alias("_mark"),  # no id: any row
    )
    wanted = nearest.join(firsts, nearest["node"] == firsts["key"]).select("key", "_id", "_mark")
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    texts = written(
        marked.join(
            wanted,
            F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_mark") == F.col("mark")),
        )
        .select("key", normal(F.col("text")).alias("plain")),
        "texts",
    )
    labels = written(nearest.select("node", F.col("node").alias("label")), "labels")

    def joined(links: DataFrame) -> DataFrame:
        """Labels after the links, which are written first and removed when they are used."""
        found = written(links, "links")
        after = joined_labels(labels, found)
        remove(found)
        return after

    def verified(pairs: DataFrame) -> DataFrame:
        # Each pair once, smaller node first; a node with several equal rows has several texts.
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return _verified(ordered.distinct(), texts, config).distinct()

    def still_open() -> DataFrame:
        """Members of the buckets that hold more than one class."""
        known = written(shared.join(labels, "node"), "labelled")
        several = (
            known.groupBy("bucket")
            .agg(F.min("label").alias("_low"), F.max("label").alias("_high"))
            .filter(F.col("_low") != F.col("_high"))
            .select("bucket")
        )
        left = written(known.join(several, "bucket"), "open")
        remove(known)
        return left

    def against(left: DataFrame, end: str) -> DataFrame:
        """Pairs of the bucket's smallest or largest node and each node of another class."""
        of_end = left.filter(F.col("node") == F.col(end)).select(
            "bucket", F.col("label").alias("_label")
        )
        return (
            left.join(of_end, "bucket")
            .filter(F.col("label") != F.col("_label"))
            .filter((F.lit(end) == "low") | (F.col("node") != F.col("low")))
            .select(F.col(end).alias("a"), F.col("node").alias("b"))
        )

    tried = nearest.filter(F.col("first").isNotNull()).select(
        F.col("first").alias("a"), F.col("node").alias("b")
    )
    def small_pairs(left: DataFrame) -> DataFrame:
        small = inner(left).filter(F.col("_members") <= config.pair_members)
        other = small.select("bucket", F.col("node").alias("_node"), F.col("label").alias("_label"))
        return (
            small.join(other, "bucket")
            .filter((F.col("label") != F.col("_label")) & (F.col("node") < F.col("_node")))
            .select(F.col("node").alias("a"), F.col("_node").alias("b"))
        )

    def inner(left: DataFrame) -> DataFrame:
        """Members but for the smallest and the largest, with the number of them."""
        rest = left.filter((F.col("node") != F.col("low")) & (F.col("node") != F.col("high")))
        return rest.join(rest.groupBy("bucket").agg(F.count("*").alias("_members")), "bucket")

    def blocks(left: DataFrame, own_only: bool) -> DataFrame:
        large = inner(left).filter(F.col("_members") > config.pair_members)
        return _in_blocks(large.select("bucket", "node", "label"), texts, config, own_only)

    labels = joined(verified(tried))
    # Blocks by themselves come first, where each text is sent once, then two by two those of
    # buckets that hold several classes still.
    for links in (
        lambda left: verified(against(left, "low").join(tried, ["a", "b"], "left_anti")),
        lambda left: verified(against(left, "high")),
        lambda left: verified(small_pairs(left)),
        lambda left: blocks(left, True).distinct(),
        lambda left: blocks(left, False).distinct(),
    ):
        left = still_open()
        nothing = left.limit(1).count() == 0
        if not nothing:
            labels = joined(links(left))
        remove(left)
        if nothing:
            break
    remove(nearest, shared, texts)
    return signed, labels.select("node", F.col("label").alias("class_key"))


def _keyed(docs: DataFrame, config: DedupConfig) -> DataFrame:
    """doc_id, mark, class_key of every document that has words."""
    signed, classes = _classes(docs, config)
    rows = signed.select("doc_id", "mark", "key")
    known = rows.join(classes, F.col("key") == F.col("node"), "left")
    return written(
        known.select("doc_id", "mark", F.coalesce("class_key", "key").alias("class_key")), "classes"
    )


def near_duplicates(docs: DataFrame, config: DedupConfig = DedupConfig()) -> DataFrame:
    """doc_id, class_id, class_size, kept: one row per document.

    ``class_id`` is the smallest doc_id of the class; ``kept`` marks that document. Documents
    without words (null, empty, blank) are alike to none: each is a class. Repeated rows are
    copies of each other, of which each row is returned; where a class has several rows of its
    smallest id, all are marked (``deduplicated`` keeps one). Null ids come after all others.
    Other columns are not read. An empty table gives no rows.
    """
    known = _keyed(docs, config)
    classes = known.groupBy("class_key").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")
    )
    # One row per class; the hot class is on the other side, which adaptive execution splits.
    found = known.join(classes, "class_key").select("doc_id", "class_id", "class_size")
    wordless = docs.filter(~has_words(F.col("text"))).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size")
    )
    return found.unionByName(wordless).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("class_id"))
    )


def deduplicated(docs: DataFrame, config: DedupConfig = DedupConfig()) -> DataFrame:
    """One row of each class, with all its columns: that of the smallest doc_id.

    Null ids come last. Documents without words all stay.
    """
    known = _keyed(docs, config)
    own_id, own_mark, n_rows = (fresh(name, docs.columns) for name in ("_id", "_mark", "_rows"))
    order = F.struct(
        F.col("doc_id").isNull().alias("none"),
        F.col("doc_id").alias("id"),
        F.col("mark").alias("mark"),
    )
    first = known.groupBy("class_key").agg(F.min(order).alias("first"))
    counts = known.groupBy("doc_id", "mark").agg(F.count("*").alias(n_rows))
    kept = (
        first.select(F.col("first.id").alias(own_id), F.col("first.mark").alias(own_mark))
        .join(
            counts, F.col(own_id).eqNullSafe(F.col("doc_id")) & (F.col(own_mark) == F.col("mark"))
        )
        .select(own_id, own_mark, n_rows)
    )
    own = F.xxhash64(docs["text"])
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept[own_id]) & (own == kept[own_mark]))
    single = rows.filter(F.col(n_rows) == 1)
    twins = rows.filter(F.col(n_rows) > 1).dropDuplicates([own_id, own_mark])
    wordless = docs.filter(~has_words(docs["text"]))
    columns = docs.columns
    return single.select(*columns).unionByName(twins.select(*columns)).unionByName(wordless)
