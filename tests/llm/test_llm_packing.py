"""Packing: ids as the library gives them, valid and tight sequences, plans of any lengths."""

import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from haulmark.llm import packing
from haulmark.llm.packing import PackConfig


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


@cache
def encoder():
    return packing.Encoder()


def same_ids(library, texts):
    for _ in range(2):  # met for the first time, and remembered
        found = encoder().encode(texts)
        wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [ids.tolist() for ids in found] == wanted


def test_ids_of_documents_and_odd_texts(library, documents):
    same_ids(library, [r["text"] or "" for r in documents.collect()])
    same_ids(
        library,
        [
            "", " ", "a b c　d", "e ́f ́", "ΣΑΣ Σ", "İI ı", "a\x1cb\x85c",
            "<|endoftext|> <|startoftext|>x a<|endoftext|>b <| endoftext|>", "it's 'S '\ts we'Ll",
            "x" * 5_000, "１２ 3½", "가 ᄀ ᅡ", "\r\n\t\x0b\x0c", "ﬁ ﬀ ẹ́",
        ],
    )


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"])), max_size=4))
def test_ids_of_any_texts(library, texts):
    if texts:
        same_ids(library, texts)


LATIN = st.characters(max_codepoint=0x24F, exclude_categories=["Cs"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(LATIN, st.sampled_from("'stdlrevm“”’—…⁄\u2028 ½²³\xa0\x85\x1cIİß"))), min_size=1, max_size=4))
def test_ids_of_latin_texts(library, texts):
    same_ids(library, texts)


def test_file_that_cuts_otherwise():
    """A tokenizer of another kind encodes whole texts."""
    name = "byte_bpe_50k.json"
    other = Tokenizer.from_file(public_tokenizers.path(name))
    text = "It's  one text,\n of 2 lines "
    assert packing.Encoder(name).encode([text])[0].tolist() == other.encode(text).ids


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(packing, "MOST_WORDS", 3)
    encoder = packing.Encoder()
    for text in ["one two three four five", "five six", "one two", "one two"]:
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def check(rows, size):
    """Each sequence is filled from 0 without gaps, up to ``size`` at most."""
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return len(held)


def laid(counts, size):
    plan = packing.plan(counts, size)
    length = np.repeat(np.arange(size + 1), counts)
    sequence, offset = plan.look_up(np.arange(len(length)), length)
    rows = [
        {"sequence_id": s, "offset": o, "length": n}
        for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True)
    ]
    found = check(rows, size)
    assert found == plan.sequences
    return found


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40))
def test_plans_of_any_counts(counts):
    """Within what any-fit packing guarantees."""
    size = len(counts)
    found = laid(np.array([0, *counts]), size)
    total = sum(x * n for x, n in enumerate(counts, 1))
    large = sum(n for x, n in enumerate(counts, 1) if 2 * x > size)
    assert max(-(-total // size), large) <= found <= max(1, 2 * total / size + 1)


def optimal(lengths, size):
    """Fewest sequences, by search."""
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for gap in set(bins):
            if gap >= lengths[i]:
                rest = list(bins)
                rest.remove(gap)
                place(i + 1, [*rest, gap - lengths[i]])
        place(i + 1, [*bins, size - lengths[i]])

    place(0, [])
    return best


def test_close_to_the_optimum():
    rng = np.random.default_rng(2)
    more = 0
    for _ in range(60):
        lengths = sorted(rng.integers(1, 13, 9).tolist(), reverse=True)
        found = laid(np.bincount(lengths, minlength=21), 20)
        more += found - optimal(lengths, 20)
    assert more <= 3


def test_exact_sums_of_one_two_three():
    counts = np.zeros(101, np.int64)
    counts[[60, 40]] = 5  # one
    counts[[70, 20, 10]] = [4, 4, 4]  # two
    counts[[80, 5]] = [3, 6]  # 80 + 5 + 5 leaves 10: not exact
    counts[[90, 3, 2]] = [2, 4, 2]  # three, of which two are equal: 90 + 3 + 3 + 2 = 98
    assert laid(counts, 100) == 5 + 4 + 3 + 2
    assert laid(np.bincount([34] * 3 + [33] * 3, minlength=101), 100) == 3


def test_many_copies_take_no_longer():
    counts = np.random.default_rng(3).integers(0, 10**9, 4097)
    counts[0] = 0
    plan = packing.plan(counts, 4096)
    total = int((counts * np.arange(4097)).sum())
    large = int(counts[2049:].sum())  # no two of them fit together
    assert plan.sequences <= 1.005 * max(total / 4096, large)
    assert len(plan.first) < 200_000


def test_sums_follow_removed_lengths():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 3, 60)
    sums = packing.Sums(counts)
    for x in rng.permutation(np.flatnonzero(counts)):
        counts[x] = 0
        sums.remove(int(x))
        new = packing.Sums(counts)
        for have, want in ((sums.one, new.one), (sums.two, new.two), (sums.three, new.three)):
            assert have.tolist() == want.tolist()


def test_documents(spark, documents, library):
    found = [r.asDict() for r in packing.pack(documents).collect()]
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
    assert by_doc.keys() == texts.keys()
    total = 0
    for doc_id, text in texts.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        parts = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        for i, r in enumerate(parts):
            own = np.array(ids[4096 * i : 4096 * (i + 1)], "<u4")
            assert (r["piece"], r["start"], r["length"]) == (i, 4096 * i, len(own))
            assert r["ids_crc32"] == zlib.crc32(own.tobytes())
        assert len(parts) == -(-len(ids) // 4096)
    assert check(found, 4096) <= -(-total // 4096) + 1


def test_sequences_hold_the_ids(documents, library):
    config = PackConfig(size=512)
    packed = [r.asDict() for r in packing.sequences(documents, config).collect()]
    texts = [r["text"] or "" for r in documents.collect()]
    wanted, found = Counter(), Counter()
    for e in library.encode_batch(texts, add_special_tokens=False):
        wanted.update([*e.ids, 1])
    for r in packed:
        assert len(r["ids"]) <= 512
        found.update(r["ids"])
    assert found == wanted


def test_odd_and_empty(odd, empty):
    found = [r.asDict() for r in packing.pack(odd).collect()]
    assert check(found, 4096) <= 17
    pieces = Counter(r["doc_id"] for r in found)
    assert pieces[1] == 2 and pieces[None] == 2 and pieces[3] == pieces[4] == pieces[5] == 1
    assert pieces[7] == -(-60_002 // 4096)
    assert all(r["length"] == 1 for r in found if r["doc_id"] in (3, 4, 5))
    assert packing.pack(empty).collect() == [] == packing.sequences(empty).collect()
    assert packing.pack(empty).columns == [*found[0]]
