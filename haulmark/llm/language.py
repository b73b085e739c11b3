"""Language ID by multilingual mixture inference.

A word of a document comes from one of the document's languages. Its likelihood in each
language is the product of the probabilities of its letter trigrams there.
Expectation-maximisation estimates the document's language proportions from the words'
likelihoods. The languages of a document are chosen by penalised likelihood: starting from
all, the weakest is dropped as long as that does not lower the likelihood by more than the
penalty saved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.tables import map_texts
from haulmark.llm.text import codes, groups, letter_table, mix64, owners, spans

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageConfig:
    sample_rows: int = 4_000  # labelled documents per language that the model is fitted on
    buckets: int = 1 << 16  # of hashed trigrams
    smoothing: float = 0.05
    rounds: int = 8  # of expectation-maximisation over all languages
    drop_rounds: int = 4  # and again without the weakest
    fixed_penalty: float = 6.0  # log likelihood a further language must add
    word_penalty: float = 0.25  # and for each word of the document
    word_cap: float = 8.0  # most log likelihood by which one word may prefer a language


def trained_on(doc_id) -> object:
    """Documents that models may learn from; rows without an id are none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def held_out(doc_id) -> object:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _trigrams(texts: list[str], buckets: int) -> tuple[np.ndarray, ...]:
    """Hashed trigram at each letter of the texts, in lower case, with word starts.

    Other characters count as one mark of a word's edge.
    """
    points, text_starts = codes([t.lower() for t in texts])
    letters = letter_table()[points]
    starts, stops = spans(letters)
    marked = np.where(letters, points, 0).astype(np.uint64)
    at = np.flatnonzero(letters)
    left = marked[np.maximum(at - 1, 0)]
    left[at == 0] = 0
    right = marked[np.minimum(at + 1, len(marked) - 1)]
    grams = mix64(left << np.uint64(42) | marked[at] << np.uint64(21) | right)
    lengths = stops - starts
    first = np.cumsum(lengths) - lengths
    return (grams & np.uint64(buckets - 1)).astype(np.int64), first, owners(starts, text_starts)


# ---- training --------------------------------------------------------------------------


def _counted(languages: list[str], buckets: int):
    number = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(languages), buckets), np.int64)
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for start, group in groups(texts):
                for lang in set(langs[start : start + len(group)]):
                    own = [t for t, x in zip(group, langs[start:], strict=False) if x == lang]
                    grams = _trigrams(own, buckets)[0]
                    seen[number[lang]] += np.bincount(grams, minlength=buckets)
        lang, bucket = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(seen[lang, bucket])],
            names=["lang", "bucket", "n"],
        )

    return count


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # languages x buckets
    config: LanguageConfig


def train(docs: DataFrame, config: LanguageConfig = LanguageConfig()) -> LanguageModel:
    """Trigram tables from text and non-null lang of the rows not held out.

    At most about ``sample_rows`` documents a language are read, chosen by a hash of their
    id; counting is spread over tasks. What reaches the driver is one table of languages
    times buckets, whatever the corpus holds.
    """
    spark = docs.sparkSession
    labelled = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & trained_on(F.col("doc_id"))
    ).select("doc_id", "lang", "text")
    known = {row["lang"]: row["n"] for row in _language_counts(docs).collect()}
    languages = sorted(known)
    if not languages:
        return LanguageModel([], np.zeros((0, config.buckets), np.float32), config)
    share = F.lit(0.0)
    for lang, n in known.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, config.sample_rows / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit("lang-1"), F.col("doc_id")), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.filter(drawn < share).select("lang", "text")
    counted = sample.mapInArrow(
        _counted(languages, config.buckets), "lang int, bucket int, n bigint"
    )
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.full((len(languages), config.buckets), config.smoothing)
    counts[table["lang"], table["bucket"]] += table["n"]
    probability = counts / counts.sum(axis=1, keepdims=True)
    return LanguageModel(languages, np.log(probability).astype(np.float32), config)


def _language_counts(docs: DataFrame) -> DataFrame:
    rows = docs.filter(F.col("lang").isNotNull() & trained_on(F.col("doc_id")))
    return rows.groupBy("lang").agg(F.count("*").alias("n"))


# ---- inference -------------------------------------------------------------------------


def _expect(
    likelihood: np.ndarray, n_words: np.ndarray, share: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after so many rounds, and the log likelihood before the last of them.

    ``likelihood`` is languages x words, scaled so that a word's best is 1; words are in order
    of their texts, of which each has at least one. ``share`` is languages x texts.
    """
    first = np.cumsum(n_words) - n_words
    for _ in range(rounds):
        joint = likelihood * np.repeat(share, n_words, axis=1)
        total = joint.sum(axis=0)
        joint /= total
        share = np.add.reduceat(joint, first, axis=1) / n_words
    fit = np.add.reduceat(np.log(total), first, dtype=np.float64)
    return share.astype(np.float32), fit


def proportions(texts: list[str], model: LanguageModel) -> np.ndarray:
    """texts x languages: proportion of each chosen language, 0 elsewhere; rows sum to 1.

    A text without letters has a row of zeros.
    """
    config, n_langs = model.config, len(model.languages)
    out = np.zeros((len(texts), n_langs))
    grams, first, owner = _trigrams(texts, config.buckets)
    if not len(first) or not n_langs:
        return out
    words = np.empty((n_langs, len(first)), np.float32)
    for i in range(n_langs):
        words[i] = np.add.reduceat(model.log_probability[i][grams], first)
    words -= words.max(axis=0)
    likelihood = np.exp(np.maximum(words, -config.word_cap))
    have, n_words = np.unique(owner, return_counts=True)
    penalty = config.fixed_penalty + config.word_penalty * n_words
    chosen = np.ones((n_langs, len(have)), bool)
    share, fit = _expect(
        likelihood, n_words, np.full(chosen.shape, 1 / n_langs, np.float32), config.rounds
    )
    trying = np.arange(len(have))  # texts that may still drop a language
    for _ in range(n_langs - 1):
        weakest = np.where(chosen[:, trying], share[:, trying], np.inf).argmin(axis=0)
        fewer = chosen[:, trying]
        fewer[weakest, np.arange(len(trying))] = False
        start = np.where(fewer, share[:, trying] + np.float32(1e-6), np.float32(0))
        start /= start.sum(axis=0)
        some = likelihood
        if len(trying) < len(have):
            held = np.zeros(len(have), bool)
            held[trying] = True
            some = likelihood[:, np.repeat(held, n_words)]
        new_share, new_fit = _expect(some, n_words[trying], start, config.drop_rounds)
        better = fit[trying] - new_fit <= penalty[trying]
        kept = trying[better]
        if not len(kept):
            break
        chosen[:, kept], share[:, kept] = fewer[:, better], new_share[:, better]
        fit[kept] = new_fit[better]
        trying = kept
    out[have] = (share / share.sum(axis=0)).T
    return out


def identify(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """``keep`` columns and lang_pred, score, languages, shares of every row.

    The prediction is the language of the largest proportion (ties: the first by name) and
    the score that proportion; ``languages`` and ``shares`` list the chosen set in that
    order. Null texts, texts without a letter and a model without languages: ``und``, 0, empty
    lists. Only ``text`` is looked at; whole texts of any length are read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def label(texts: list[str | None]) -> Iterator[tuple[int, int, list[pa.Array]]]:
        model = shipped.value
        for start, group in groups(texts):
            names, scores, sets, shares = [], [], [], []
            for row in proportions(group, model):
                order = [i for i in np.argsort(-row, kind="stable") if row[i] > 0]
                names.append(model.languages[order[0]] if order else UNKNOWN)
                scores.append(min(1.0, float(row[order[0]])) if order else 0.0)
                sets.append([model.languages[i] for i in order])
                shares.append([float(row[i]) for i in order])
            yield start, len(group), [
                pa.array(names, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array(sets, pa.list_(pa.string())),
                pa.array(shares, pa.list_(pa.float64())),
            ]

    added = {
        "lang_pred": "string",
        "score": "double",
        "languages": "array<string>",
        "shares": "array<double>",
    }
    return map_texts(docs, keep, added, label)
