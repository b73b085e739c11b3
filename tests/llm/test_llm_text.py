"""Operators on whole texts: pages, pieces, languages, token counts, quality."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmark.llm import html_blocks, language, pieces, quality, token_counts
from haulmark.llm.queries import QUERIES
from haulmark.llm.text import codes, groups, owners, span_hashes, spans


def rows(frame):
    return [r.asDict() for r in frame.collect()]


def test_spans_and_groups():
    texts = ["ab  c", "", " x", "yz"]
    points, starts = codes(texts)
    begin, end = spans(points != 32)
    joined = " ".join(texts) + " "
    assert [joined[a:b] for a, b in zip(begin, end, strict=True)] == ["ab", "c", "x", "yz"]
    assert owners(begin, starts).tolist() == [0, 0, 2, 3]
    same = span_hashes(np.array([5, 6, 9, 5, 6], np.uint32), np.array([0, 3]), np.array([2, 5]))
    assert same[0] == same[1]
    big = ["a" * 300_000, None, "b" * 300_000, "c" * 3_000_000]
    assert [(s, len(g)) for s, g in groups(big)] == [(0, 2), (2, 1), (3, 1)]


# ---- pages ---------------------------------------------------------------------------

PAGES = [
    ("", ""),
    (None, ""),
    ("<article><h1>T &amp; U</h1><p>To.</p><p>a\n b&nbsp;<b>c</b></article><footer>f", "T & U\n\nTo.\n\na b c"),
    ("<nav><a href=x>m</a></nav><main><p>One <a href=y>link</a> in it</p><aside>s</aside></main>", "One link in it"),
    ("<body><div class='cookie-banner'>We use cookies on this site today</div><article><p>x<p>y</article>", "x\n\ny"),
    ("<article><p>real</p><div id=comments><p>I liked this a lot, thanks</p></div></article>", "real"),
    ("<article><p>a</p><form><label>Mail</label><input><button>Go</button></form><p>b</p></article>", "a\n\nb"),
    ("<article><script>if (a<b) '</p>'</script><style>p{}</style><p>q &lt; r &#233;&#x1F600;</p></article>", "q < r é\U0001f600"),
    ("<head><title>no</title></head><body><article>loose<br>text<!-- no <p>hidden</p> --></article>", "loose text"),
    ("<article><ul><li>one<li>two</ul></article><div class=\"ad\">buy</div>", "one\n\ntwo"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html_blocks.main_text(page) == text


def test_blocks_count_words_and_links():
    found = html_blocks.blocks("<p>a <a href=x>b c</a> d</p><div><a>e</a></div>")
    assert [(b.n_words, b.link_density) for b in found] == [(4, 0.5), (1, 1.0)]
    described = html_blocks.describe(found)
    assert described[0, 4] == 1 and described[1, 2] == 4 and described[1, 3] == 0.5


def test_tree_fits_its_table():
    for page in html_blocks.LABELLED:
        predicted = html_blocks.trained().predict(html_blocks.describe(html_blocks.labelled(page)))
        assert predicted.tolist() == [bool(line[-1]) for line in page]


def test_tree_decides_by_words_links_and_neighbours():
    tree = html_blocks.trained()
    used = {html_blocks.FEATURES[f] for f in tree.feature if f >= 0}
    assert {"words", "link density"} <= used
    assert used & {"words before", "words after"}
    texts = [f for f in tree.feature if 0 <= f < html_blocks.HINTS]
    assert len(texts) > sum(f >= html_blocks.HINTS for f in tree.feature)


LONG_1 = "The river rose by two metres during the night, and by the morning the lower fields were under water."
LONG_2 = "Farmers had moved their cattle to the hills the day before, after a warning that few of them had believed at first."
LONG_3 = "Nobody was hurt, but the road to the village will stay closed until the end of the week, the council said."

UNMARKED = [
    # comments that are articles themselves
    (f"<article><h1>Flood</h1><p>{LONG_1}</p></article><ol class='comment-list'><li><article class='comment-body'>"
     f"<p>{LONG_2}</p></article></li></ol>", ["Flood", LONG_1]),
    (f"<article><p>{LONG_1}</p></article><section class='comments'><article><p>{LONG_2}</p></article></section>", [LONG_1]),
    # names that only look like those of parts
    (f"<article><div class='form-factor'>{LONG_1}</div><p class='share-price'>Up.</p><div class='social-policy'>{LONG_2}"
     f"</div><p class='intro search-results'>{LONG_3}</p></article>", [LONG_1, "Up.", LONG_2, LONG_3]),
    # no names at all
    ("<p>Home</p><p>About</p><p>Contact</p>", []),
    (f"<p>Home</p><p>About</p><p>Contact</p><h1>Flood in the valley</h1><p>{LONG_1}</p><p>{LONG_2}</p><p>{LONG_3}</p>"
     "<p>© 2024 Example Media</p>", ["Flood in the valley", LONG_1, LONG_2, LONG_3]),
    (f"<div>{LONG_1}</div><div>Save 20 % on boots today</div><div>{LONG_2}</div><div><a href=x>Read more stories</a></div>",
     [LONG_1, LONG_2]),
    (f"<ul><li><a href=a>News</a><li><a href=b>Sport</a></ul><div>{LONG_1}<br>{LONG_2}</div><h3>More</h3><ul><li>"
     "<a href=c>Storm on the coast</a></ul>", [f"{LONG_1} {LONG_2}"]),
    (f"<div>{LONG_3}</div>", [LONG_3]),
]


@pytest.mark.parametrize("page, texts", UNMARKED)
def test_pages_that_do_not_name_their_parts(page, texts):
    assert html_blocks.main_text(page) == "\n\n".join(texts)


def test_pages_by_their_article_element(spark, sf_dir):
    """The given pages mark their article, so a plain reading of it is the expected text."""
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: r for r in rows(QUERIES["op1_main_text"](spark, sf_dir))}
    assert len(found) == pages.count()
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article)
        texts = [" ".join(html.unescape(re.sub(r"<.*?>", "", p)).split()) for p in parts]
        expected = "\n\n".join(t for t in texts if t)
        assert found[r["page_id"]]["text"] == expected
        assert found[r["page_id"]]["n_chars"] == len(expected)


def test_pages_odd_cases(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars int"
    data = [(1, None, None, "x", 1), (1, None, None, "x", 1), (None, "u", "<p>" + "a b " * 90_000, None, None)]
    found = rows(html_blocks.extract(spark.createDataFrame(data, schema)))
    assert sorted(r["n_chars"] for r in found) == [0, 0, 359_999]
    assert rows(html_blocks.extract(spark.createDataFrame([], schema))) == []


# ---- pieces --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(*pieces.load())


def best_score(text, vocabulary, table):
    """Highest sum of scores over all segmentations of the whole text, without a trie."""
    marked = "▁" + text.replace("▁", "\x00").replace(" ", "▁") if text else ""
    longest, best = max(map(len, table)), [0.0]
    for end in range(1, len(marked) + 1):
        ways = [
            best[start] + table[marked[start:end]]
            for start in range(max(0, end - longest), end)
            if marked[start:end] in table
        ]
        if marked[end - 1] not in table:
            ways.append(best[end - 1] + vocabulary.unknown_score)
        best.append(max(ways))
    return best[-1]


def test_best_segmentation_and_round_trip(vocabulary):
    names, scores, special = pieces.load()
    table = {
        p: scores[i] for i, p in enumerate(names) if i not in special and not pieces._BYTE.fullmatch(p)
    }
    generator = random.Random(2)
    alphabet = "abcde ent the  \n\tIng ▁é中ß\U0001f60001239.,"
    texts = ["", " ", "▁", "a" * 300, "<s> </s> <unk> <0x41>"] + [
        "".join(generator.choice(alphabet) for _ in range(generator.randint(0, 40)))
        for _ in range(400)
    ]
    ids, n = vocabulary.encode(texts)
    ends = np.cumsum(n)
    fallback = set(vocabulary.byte_id.values())
    for a, b, text in zip(ends - n, ends, texts, strict=True):
        own = ids[a:b].tolist()
        assert vocabulary.decode(own) == text
        unknown = b"".join(vocabulary.bytes_of[i] for i in own if i in fallback).decode()
        total = sum(scores[i] for i in own if i not in fallback)
        total += vocabulary.unknown_score * len(unknown)
        assert total == pytest.approx(best_score(text, vocabulary, table))


def test_double_array_holds_each_piece(vocabulary):
    names, _, special = pieces.load()
    for i in range(259, len(names), 97):
        node = 0
        for character in names[i]:
            following = vocabulary.base[node] + int(vocabulary.code[ord(character)])
            assert vocabulary.check[following] == node
            node = following
        assert vocabulary.leaf[node] == i


def test_memory_of_stretches_is_bounded(vocabulary, monkeypatch):
    before = vocabulary.encode(["some text here"])[0].tolist()
    monkeypatch.setattr(pieces, "MOST_STRETCHES", 2)
    vocabulary.encode(["many other words to remember"])
    assert vocabulary.encode(["some text here"])[0].tolist() == before


def test_pieces_odd_cases(odd, empty):
    encoded = pieces.encode(odd, odd.columns)
    assert encoded.columns == [*odd.columns, "ids", "n_ids", "n_fallback", "same"]
    found = rows(encoded)
    assert len(found) == odd.count() and all(r["same"] for r in found)
    assert all(r["ids"] == [] for r in found if not r["text"])
    back = rows(pieces.decode(encoded.withColumnRenamed("text", "before"), ["before"]))
    assert all(r["text"] == (r["before"] or "") for r in back)
    assert rows(pieces.encode(empty, empty.columns)) == []


# ---- languages -----------------------------------------------------------------------


def test_language_of_held_out_documents(spark, documents, sf_dir):
    found = {r["doc_id"]: r for r in rows(QUERIES["op3_language"](spark, sf_dir))}
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    assert found.keys() == truth.keys()
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [i for i, r in found.items() if r["held_out"]]
    assert sum(found[i]["lang_pred"] == truth[i] for i in held) >= 0.95 * len(held)


def test_mixture_of_two_languages(documents):
    model = language.train(documents)
    one = {r["lang"]: r["text"] for r in documents.filter("length(text) > 1500").collect()}
    first, second = sorted(one)[:2]
    n = min(len(one[first]), len(one[second]))
    texts = [one[first][:n] + " " + one[second][: n // 2], one[second], "1234 !?", ""]
    found = language.proportions(texts, model)
    a, b = model.languages.index(first), model.languages.index(second)
    assert found[0, a] > found[0, b] > 0.2 and found[0].sum() == pytest.approx(1)
    assert found[1, b] > 0.9
    assert not found[2:].any()
    alone = language.proportions(texts[:1], model)
    assert np.allclose(alone[0], found[0], atol=1e-4)  # other texts of a batch do not matter


def test_expectation_is_maximum_likelihood():
    """Proportions reached by many rounds are those of the best fit on a fine grid."""
    generator = np.random.default_rng(3)
    likelihood = generator.random((2, 50)).astype(np.float32)
    share, _ = language._expect(
        likelihood, np.array([50]), np.full((2, 1), 0.5, np.float32), 300
    )
    grid = np.linspace(0, 1, 2001)
    fits = [np.log(p * likelihood[0] + (1 - p) * likelihood[1]).sum() for p in grid]
    assert share[0, 0] == pytest.approx(grid[int(np.argmax(fits))], abs=2e-3)


def test_language_odd_cases(spark, odd, empty):
    model = language.train(odd)
    assert model.languages == ["en", "fr"] or model.languages == ["en"]
    found = language.identify(odd, model, odd.columns)
    assert found.columns == [*odd.columns, "lang_pred", "score_", "languages", "shares"]
    for r in rows(found):
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (r["score_"] > 0) == letters
    nothing = language.train(empty)
    assert {r["lang_pred"] for r in rows(language.identify(odd, nothing, ["doc_id"]))} == {"und"}
    assert rows(language.identify(empty, model, ["doc_id"])) == []


def test_held_out_rows_are_not_learned(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0]
    data = [(i, "zzz qqq", "xx" if i in held else "en") for i in range(100)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    assert language.train(frame).languages == ["en"]


# ---- token counts --------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))


def test_counts_equal_the_library(library, documents):
    import public_tokenizers

    generator = random.Random(3)
    alphabet = "abcsdmtrvel'' '  \n\t 019!?.,é中ñ\x85\xa0　​\U0001f600²½"
    texts = [
        "".join(generator.choice(alphabet) for _ in range(generator.randint(0, 60)))
        for _ in range(3000)
    ]
    texts += ["it's we're they'll I've 'r 're'll ''s !'s 'v", "<|endoftext|> a  <|endoftext|>", "x" * 3000, " " * 700]
    texts += [r["text"] for r in documents.limit(60).collect()]
    with open(public_tokenizers.path(token_counts.TOKENIZER), "rb") as file:
        counter = token_counts.Counter(file.read())
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    found = np.concatenate([counter.counts(group) for _, group in groups(texts)])
    assert found.tolist() == expected
    assert counter._counts(texts[:50]).tolist() == [len(library.encode(t).ids) for t in texts[:50]]


def test_counts_without_room_for_states(library, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(token_counts, "MOST_STATES", 5)
    with open(public_tokenizers.path(token_counts.TOKENIZER), "rb") as file:
        counter = token_counts.Counter(file.read())
    texts = ["unbelievable circumstances", "a b c", "zzzzqqqq"]
    assert counter.counts(texts).tolist() == [len(library.encode(t).ids) for t in texts]
    assert len(counter.states) <= 6


def test_chunk_maps_compose(monkeypatch):
    """Entry states by the parallel scan are those of reading from the left."""
    generator = np.random.default_rng(1)
    kinds = generator.integers(0, 12, (37, 8)).astype(np.uint8)
    move, _ = token_counts.splitter()
    state, expected = token_counts.FRESH, []
    for chunk in kinds:
        expected.append(state)
        for kind in chunk:
            state = int(move[int(kind) * 12 + state])
    assert token_counts.entry_states(kinds).tolist() == expected


def test_token_counts_odd_cases(odd, empty, library):
    found = rows(token_counts.token_counts(odd))
    expected = sorted(
        (len((r["text"] or "").encode()), len(library.encode(r["text"] or "").ids))
        for r in odd.collect()
    )
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in found) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in found)
    assert rows(token_counts.token_counts(empty)) == []


# ---- quality -------------------------------------------------------------------------


def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in rows(QUERIES["op8_quality"](spark, sf_dir))}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    held = [(r["quality"], found[r["doc_id"]]) for r in labels if found[r["doc_id"]]["held_out"]]
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for _, r in held)
    good = [r["score"] for label, r in held if label == 1]
    bad = [r["score"] for label, r in held if label == 0]
    better = sum(g > b for g in good for b in bad) / (len(good) * len(bad))
    assert better > 0.95
    assert sum(g >= 0.3 for g in good) >= 0.98 * len(good)


def test_features_are_words_and_pairs():
    slot, owner, n = quality.features(["a b!", "", "b! b!", "x x"], 1 << 18)
    assert n.tolist() == [5, 0, 7, 3]  # a, b, ! and their pairs
    again, _, _ = quality.features(["x x"], 1 << 18)
    assert slot[owner == 3].tolist() == again.tolist()
    other, _, _ = quality.features(["yy yy"], 1 << 18)
    assert again[-1] == other[-1]  # a word and itself: one pair whatever the word


def test_training_step_by_step():
    """The sparse learner against a plain one that keeps a dense vector."""
    config = quality.QualityConfig(slots=64, epochs=2)
    texts, labels = ["good text here", "bad !!! bad", "fine words", "!!! ???"], [1, 0, 1, 0]
    weights, bias = quality.fit(texts, labels, config)
    z, n = np.zeros(65), np.zeros(65)

    def dense(text):
        x = np.zeros(65)
        slot, _, _ = quality.features([text], 64)
        for s in slot:
            x[s] += 1 / np.sqrt(len(slot))
        x[64] = 1
        return x

    def current():
        strength = np.append(np.full(64, config.l1), 0.0)
        rate = (config.beta + np.sqrt(n)) / config.alpha + config.l2
        return np.where(np.abs(z) <= strength, 0, -(z - np.sign(z) * strength) / rate)

    for _ in range(2):
        for text, label in zip(texts, labels, strict=True):
            x, w = dense(text), current()
            g = (1 / (1 + np.exp(-w @ x)) - label) * x  # both classes weigh 1 here
            z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / config.alpha * w
            n += g * g
    assert np.allclose(np.append(weights, bias), current(), atol=1e-5)


def test_quality_odd_cases(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (2, 1, 0), (7, 0, 1), (8, None, 1), (None, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    model = quality.train(odd, labels)
    found = quality.score(odd, model, odd.columns)
    assert found.columns == [*odd.columns, "score_", "predicted"]
    scored = rows(found)
    assert len(scored) == odd.count() and all(0 <= r["score_"] <= 1 for r in scored)
    unlabelled = quality.train(odd, labels.limit(0))
    assert {r["score_"] for r in rows(quality.score(odd, unlabelled, odd.columns))} == {0.5}
    assert rows(quality.score(empty, model, ["doc_id"])) == []


def test_threshold_column(spark, odd):
    model = quality.QualityModel(np.zeros(1 << 18, np.float32), -5.0, quality.QualityConfig())
    low = quality.score(odd, model, ["doc_id"]).agg(F.max("predicted")).first()[0]
    assert low == 0


def test_quality_learns_from_one_row_of_an_id(spark):
    """Any number of rows of one id count as one row, whatever their order."""
    texts = [(n, f"fine words number {n} in a row" if n % 3 else f"BUY NOW {n} !!!") for n in range(1, 120)]
    labels = spark.createDataFrame([(n, int(n % 3 > 0)) for n, _ in texts], "doc_id long, quality int")
    plain = spark.createDataFrame(texts, "doc_id long, text string")
    copies = plain.filter("doc_id <= 3").crossJoin(spark.range(300)).drop("id")
    one, many = (quality.train(d, labels) for d in (plain, plain.unionByName(copies)))
    assert np.array_equal(one.weights, many.weights) and one.bias == many.bias
    model = quality.train(plain, labels.limit(0))
    assert quality.scores(["anything", ""], model).tolist() == [0.5, 0.5]
