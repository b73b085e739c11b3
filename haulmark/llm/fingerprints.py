"""SimHash fingerprints and a search by permuted block tables. Built-in expressions only."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.tables import written

TERM_WORDS = 5
RADIUS = 3
BLOCK_BITS = (13, 13, 13, 13, 12)  # five blocks: at most three differ, so two agree
RANGES_PER_PARTITION = 4
_SPACE = " \t\n\x0b\x0c\r"
_PAIR = 1 | (1 << 32)
_LOW = (1 << 32) - 1


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-case words in order; null if the text is null, empty or blank."""
    words = F.split(F.btrim(F.lower(text), F.lit(_SPACE)), r"[\x20\x09-\x0D]+")
    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.length(F.btrim(text, F.lit(_SPACE))) > 0, hashes)


def runs(hashes: Column) -> Column:
    """Terms: a hash for each run of five words; one for all words if there are fewer."""
    n = F.size(hashes)
    many = F.transform(
        F.slice(hashes, F.lit(1), n - (TERM_WORDS - 1)),
        lambda first, i: F.xxhash64(
            first, *[F.get(hashes, i + k) for k in range(1, TERM_WORDS)]
        ),
    )
    return F.when(n >= TERM_WORDS, many).when(n > 0, F.array(F.xxhash64(hashes)))


def _votes(term: Column) -> list[Column]:
    """32 sums; the i-th counts bit i in its lower half and bit i + 32 in its upper half."""
    return [
        F.sum(F.shiftright(term, i).bitwiseAND(F.lit(_PAIR))).alias(f"_v{i}") for i in range(32)
    ]


def _signs(n_terms: Column) -> Column:
    """Bit i is set if more than half of the terms set it."""
    fingerprint = F.lit(0).cast("bigint")
    for i in range(32):
        for half, count in (
            (0, F.col(f"_v{i}").bitwiseAND(F.lit(_LOW))),
            (32, F.shiftrightunsigned(F.col(f"_v{i}"), 32)),
        ):
            bit = (count * 2 > n_terms).cast("bigint")
            fingerprint = fingerprint.bitwiseOR(F.shiftleft(bit, i + half))
    return fingerprint


def simhash(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``fingerprint`` (bigint), one row per distinct keys.

    Every occurrence of a term votes on each bit, so a term weighs as often as it occurs. No
    terms: fingerprint 0. Votes are counted two to a number, before any shuffle.
    """
    hashed = rows.select(*keys, word_hashes(F.col(text)).alias("_words"))
    split = hashed.select(*keys, F.explode_outer(runs(F.col("_words"))).alias("_term"))
    votes = split.groupBy(*keys).agg(F.count("_term").alias("_n"), *_votes(F.col("_term")))
    empty = F.col("_n") == 0
    return votes.select(
        *keys, F.when(empty, F.lit(0)).otherwise(_signs(F.col("_n"))).alias("fingerprint")
    )


def likeness(left: Column, right: Column) -> Column:
    """Share of the 64 bits that agree."""
    return 1 - F.bit_count(left.bitwiseXOR(right)) / 64.0


def as_text(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# ---- all fingerprints within a radius --------------------------------------------------


def _block(fingerprint: Column, index: int) -> Column:
    low = sum(BLOCK_BITS[:index])
    mask = (1 << BLOCK_BITS[index]) - 1
    return F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit(mask))


def _tables(fingerprint: Column) -> Column:
    """One entry per pair of blocks: the blocks moved to the front, as (table, key)."""
    entries = [
        F.struct(
            F.lit(t).alias("table"),
            F.shiftleft(_block(fingerprint, a), BLOCK_BITS[b])
            .bitwiseOR(_block(fingerprint, b))
            .alias("key"),
        )
        for t, (a, b) in enumerate(combinations(range(len(BLOCK_BITS)), 2))
    ]
    return F.explode(F.array(*entries))


def _first_table(left: Column, right: Column) -> Column:
    """The first table in which two fingerprints meet, so that a pair counts once."""
    same = [_block(left, i) == _block(right, i) for i in range(len(BLOCK_BITS))]
    first = F.lit(None).cast("int")
    for t, (a, b) in reversed(list(enumerate(combinations(range(len(BLOCK_BITS)), 2)))):
        first = F.when(same[a] & same[b], F.lit(t)).otherwise(first)
    return first


def within(queries: DataFrame, all_prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, found) pairs of distinct fingerprints at most ``radius`` (3 or less) bits apart.

    Both inputs have ``fingerprint``; equal ones are one, so a group of copies is one entry.
    Five blocks of which at most three differ leave two that agree: each fingerprint stands in
    the ten tables of block pairs, under a key of 25 or 26 bits, and meets only its like.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"five blocks find fingerprints within {RADIUS} bits, not {radius}")

    def entries(frame: DataFrame, name: str) -> DataFrame:
        distinct = frame.select(F.col("fingerprint").alias(name)).distinct()
        return distinct.select(name, _tables(F.col(name)).alias("_e")).select(name, "_e.*")

    left, right = entries(queries, "query"), entries(all_prints, "found")
    near = F.bit_count(F.col("query").bitwiseXOR(F.col("found"))) <= radius
    once = F.col("table") == _first_table(F.col("query"), F.col("found"))
    met = left.withColumnsRenamed({"table": "_t", "key": "_k"}).join(
        right, (F.col("_t") == F.col("table")) & (F.col("_k") == F.col("key")) & near & once
    )
    return met.select("query", "found")


# ---- documents next to their neighbour -------------------------------------------------


def _ranges(docs: DataFrame, n: int) -> DataFrame:
    """Documents with their range of descending doc_id.

    Range bounds are quantiles; a document finds its range by bisection. Null ids come last.
    """
    shares = [(i + 1) / n for i in range(n - 1)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * n)).first()[0] if shares else None
    bounds = sorted(set(found or []))
    if bounds:
        held = F.array(*[F.lit(b) for b in bounds])

        def halve(state: Column, _: Column) -> Column:
            middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
            above = F.get(held, middle) >= F.col("doc_id")
            done = state["low"] >= state["high"]
            return F.when(done, state).otherwise(
                F.struct(
                    F.when(above, state["low"]).otherwise(middle + 1).alias("low"),
                    F.when(above, middle).otherwise(state["high"]).alias("high"),
                )
            )

        start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
        steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
        ascending = F.aggregate(steps, start, halve)["low"]
        number = F.lit(len(bounds)) - ascending
    else:
        number = F.lit(0)
    last = F.lit(len(bounds) + 1)  # of the documents without an id
    number = F.when(F.col("doc_id").isNull(), last).otherwise(number).cast("int")
    return docs.withColumn("range", number)


def followed(docs: DataFrame) -> DataFrame:
    """doc_id, text, range, place, next_text, guest: the next document by descending doc_id.

    Repeated ids are ordered by text, null ids come last, after the last comes the first. Every
    range also holds the first document of the range that follows, as its ``guest``, so that
    windows over ranges of bounded size see each neighbour.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_PARTITION
    rows = _ranges(
        docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")), n
    )
    by_id = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    ids = rows.groupBy("range").agg(F.max("doc_id").alias("_first"))  # one row per range
    first = Window.partitionBy("range").orderBy("text")
    heads = (
        rows.withColumnRenamed("range", "_r")
        .join(
            F.broadcast(ids),
            (F.col("_r") == F.col("range")) & F.col("doc_id").eqNullSafe(F.col("_first")),
        )
        .withColumn("_n", F.row_number().over(first))
        .filter("_n = 1")
        .select("doc_id", "text", "range")
    )
    order = Window.orderBy("range")  # over one row per range
    before = ids.select(
        "range",
        F.coalesce(
            F.lag("range").over(order),
            F.max("range").over(order.rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("_before"),
    )
    guests = heads.join(F.broadcast(before), "range").select(
        "doc_id", "text", F.col("_before").alias("range"), F.lit(True).alias("guest")
    )
    both = rows.withColumn("guest", F.lit(False)).unionByName(guests)
    inside = Window.partitionBy("range").orderBy("guest", *by_id)
    return both.select(
        "*",
        F.row_number().over(inside).alias("place"),
        F.lead("text").over(inside).alias("next_text"),
    )


def edited(text: Column, other: Column) -> Column:
    """The second half of the text replaced by as much of the other text, or all of it."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half)
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike neighbours are.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (16 hex digits),
    near_edited, near_next. Null texts count as empty; equal texts have equal fingerprints;
    a single document is its own neighbour; repeated rows each get a row. Texts are shuffled
    once, by ranges of doc_id; all later steps stay in that partitioning.
    """
    rows = followed(docs).withColumn(
        "edited",
        F.when(~F.col("guest"), edited(F.col("text"), F.coalesce("next_text", F.lit("")))),
    )
    keys = ["range", "place", "guest", "doc_id", "n_chars", "edited_sha256"]
    variants = rows.select(
        "range",
        "place",
        "guest",
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("variant"), F.col("text")),
                F.struct(F.lit(1).alias("variant"), F.col("edited").alias("text")),
            )
        ).alias("_v"),
    ).select(*keys, "_v.*")
    prints = simhash(variants, [*keys, "variant"])
    both = prints.groupBy(*keys).agg(
        F.max(F.when(F.col("variant") == 0, F.col("fingerprint"))).alias("own"),
        F.max(F.when(F.col("variant") == 1, F.col("fingerprint"))).alias("changed"),
    )
    inside = Window.partitionBy("range").orderBy("place")
    known = both.withColumn("following", F.lead("own").over(inside)).filter(~F.col("guest"))
    return known.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
        F.col("own").alias("bits"),
    )


def with_neighbours(prints: DataFrame, every: int = 50) -> DataFrame:
    """Add ``n_near``: documents within the radius of each row whose doc_id ``every`` divides.

    The row itself and its copies count; other rows get null. ``prints`` has ``bits``.
    """
    held = written(prints, "fingerprints")
    all_prints = held.groupBy(F.col("bits").alias("fingerprint")).agg(
        F.count("*").alias("_documents")
    )
    asked = held.filter(F.col("doc_id") % every == 0)
    pairs = within(asked.select(F.col("bits").alias("fingerprint")), all_prints)
    counts = (
        pairs.join(all_prints, F.col("found") == F.col("fingerprint"))
        .groupBy("query")
        .agg(F.sum("_documents").alias("n_near"))
    )
    answered = asked.join(counts, F.col("bits") == F.col("query"), "left").drop("query")
    others = held.filter(F.coalesce(F.col("doc_id") % every != 0, F.lit(True)))
    none = F.lit(None).cast("bigint").alias("n_near")
    return answered.unionByName(others.select("*", none)).drop("bits")
