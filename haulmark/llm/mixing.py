"""Mix sources to target weights: systematic sampling along the words of a source.

Built-in expressions only. A document of a source whose target is ``rate`` times its size
expects ``rate`` copies. Within the source, in order of size, the expected copies are summed
up from one offset per source, and a copy is taken for each whole number passed: every
document gets the rate rounded down or up, and neighbours of like size balance each other,
so the words taken stay near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.tables import fresh, numbered, written

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3  # times its size that a source, and so a document, may be taken
WEIGHTS = 3  # sources weigh 1, 2, ..., WEIGHTS in turn
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def offset(source: Column, seed: str = SEED) -> Column:
    """The source's number in [0, 1), the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\x00null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, first (place of its first document), target, rate.

    ``sizes`` has source, size, position. Sources weigh 1, 2, 3 in turn by code point, null
    last, and share the words of all. A target above three times its source stops there; the
    rest is shared anew by weight until none is above. Each round is one aggregate over the
    table of sources; only its two sums come to the driver.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.min("position").alias("first")
    )
    ranked = numbered(
        written(by_source, "sources"), [F.col("source").asc_nulls_last()], "rank"
    ).withColumn("weight", F.col("rank") % WEIGHTS + 1)
    sources = written(ranked, "weights")
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    full, stopped, weight = F.lit(False), -1, 0
    most = F.col("source_size") * MOST
    while True:
        row = sources.agg(
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if row["stopped"] == stopped and row["weight"] == weight:
            break
        stopped, weight = row["stopped"], row["weight"]
        left = F.lit(words - stopped).cast("decimal(38,0)")
        full = full | (most * F.lit(weight).cast("decimal(38,0)") < left * F.col("weight"))
    shared = F.lit(words - stopped).cast("bigint") * F.col("weight") / F.lit(float(max(weight, 1)))
    target = F.when(full, most.cast("double")).otherwise(shared.cast("double"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    return sources.withColumn("target", target).select(
        "source", "source_size", "first", "target", F.coalesce(rate, F.lit(0.0)).alias("rate")
    )


def _decided(rows: DataFrame, seed: str) -> DataFrame:
    """``rows`` (doc_id, source, size and keys of their own) with the copies of each."""
    keys = [c for c in rows.columns if c not in ("doc_id", "source", "size")]
    order = [
        F.col("source").asc_nulls_last(),
        F.col("size"),
        F.col("doc_id").asc_nulls_last(),
        *keys,
    ]
    placed = numbered(written(rows, "sizes"), order)
    shares = targets(placed).withColumnRenamed("source", "_source")
    # One narrow row per source: adaptive execution broadcasts it while it is small, and
    # splits the hot source of the other side when it is not.
    joined = placed.join(shares, F.col("source").eqNullSafe(F.col("_source")))
    place = (F.col("position") - F.col("first") + 1).cast("double")
    start = offset(F.col("source"), seed)
    passed = F.floor(place * F.col("rate") + start) - F.floor((place - 1) * F.col("rate") + start)
    copies = F.when(F.col("size") > 0, passed).otherwise(F.lit(0)).cast("bigint")
    return joined.withColumn("copies", copies).drop("position", "first", "_source")


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, rate, copies.

    Null texts and texts without words have size 0 and no copies; a source without words has
    target 0. Null sources are one source, weighed last. Repeated rows are sampled each on
    its own. Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    return _decided(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), seed)


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it.

    Decisions are tied to rows by doc_id and a hash of source and text. Rows that repeat
    share one sum of copies, so they are reduced to one row before they are repeated.
    """
    own_id, own_row, key, n_copies, n_twins, copy = (
        fresh(name, docs.columns) for name in ("_id", "_row", "_key", "_copies", "_twins", "_copy")
    )
    row = F.xxhash64("source", "text")
    size = n_words(F.col("text")).alias("size")
    decided = _decided(docs.select("doc_id", "source", size, row.alias(own_row)), seed)
    taken = (
        decided.filter("copies > 0 or size > 0")
        .groupBy("doc_id", own_row)
        .agg(F.sum("copies").alias(n_copies), F.count("*").alias(n_twins))
        .withColumnRenamed("doc_id", own_id)
        .filter(F.col(n_copies) > 0)
    )
    on = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_row))
    rows = docs.withColumn(key, row).join(taken, on)
    single, twins = rows.filter(F.col(n_twins) == 1), rows.filter(F.col(n_twins) > 1)
    kept = single.unionByName(twins.dropDuplicates(["doc_id", key]))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n_copies)))
    return kept.withColumn(copy, copies).select(*docs.columns)
