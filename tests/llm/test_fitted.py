"""Language ID (8), toxicity (6) and main-text extraction (7): held-out accuracy and edge cases."""

import random
import zlib

import numpy as np
import pytest

from stratawell.llm import bayes_language, crf_extract, deobfuscation

WORDS = {
    "en": "the of and to in is that it was for with on as are this have from not but they which".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur".split(),
}
TOXIC = ["idiot", "stupid", "moron"]


def spoken(seed, lang, n=40):
    draw = random.Random(f"{seed}{lang}")
    return " ".join(draw.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def language_model(spark):
    rows = [(i, spoken(i, lang), lang) for i, lang in enumerate(list(WORDS) * 40)]
    rows += [(1000, None, "en"), (1001, "text without a label", None)]
    return bayes_language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), buckets=1 << 12)


def test_languages_of_unseen_texts(language_model, clashing):
    rows = [(i, spoken(i + 5000, lang, 8)) for i, lang in enumerate(list(WORDS) * 20)]
    got = {r.doc_id: r for r in bayes_language.predict(clashing(rows), language_model).collect()}
    right = [got[i].lang_pred == lang for i, lang in enumerate(list(WORDS) * 20)]
    assert np.mean(right) > 0.97 and all(0 <= r.score <= 1 for r in got.values())


def test_unknown_language_and_repeats(language_model, frame, clashing):
    rows = [(1, None), (2, ""), (3, "123 !? ²"), (4, spoken(1, "de")), (4, spoken(1, "de")), (None, "der die und " * 50_000)]
    got = bayes_language.predict(frame(rows), language_model).collect()
    assert sorted(r.lang_pred for r in got) == ["de", "de", "de", "und", "und", "und"]
    kept = bayes_language.keep_identified(clashing(rows), language_model)
    assert kept.columns == clashing(rows).columns and kept.count() == 3
    assert bayes_language.predict(frame([]), language_model).count() == 0


def test_no_labels_no_language(frame):
    model = bayes_language.fit(frame([], "doc_id long, text string, lang string"))
    assert [r.lang_pred for r in bayes_language.predict(frame([(1, "hello")]), model).collect()] == ["und"]


def test_scores_equal_a_plain_sum(language_model):
    def plain(text):
        chars = [c if c.isalpha() else " " for c in f" {text.lower()} "]
        total, n = np.zeros(3), 0
        for size in language_model.orders:
            for i in range(len(chars) - size + 1):
                gram = chars[i : i + size]
                if all(c == " " for c in gram):
                    continue
                code = 0
                for k, c in enumerate(gram):
                    code = (code * 0x100000001B3 + ord(c)) % 2**64 if k else ord(c)
                mixed = ((code ^ (code >> 29)) * (0x9E3779B97F4A7C15 + 2 * size)) % 2**64
                total += language_model.weights[(mixed >> 40) % len(language_model.weights)]
                n += 1
        return total / np.sqrt(n)

    texts = [spoken(3, "fr", 5), "Das ist, nicht!", "ça"]
    names, posterior = bayes_language.score(texts, language_model)
    for text, name, p in zip(texts, names, posterior):
        total = plain(text)
        likely = np.exp(total - total.max())
        assert language_model.languages[total.argmax()] == name
        assert p == pytest.approx(likely.max() / likely.sum(), abs=1e-4)


def test_held_out_rows_follow_the_checksum(frame):
    from pyspark.sql import functions as F

    got = frame([(i, "") for i in range(50)]).select("doc_id", bayes_language.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


@pytest.fixture(scope="module")
def letters(spark):
    rows = [(i, f"{spoken(i, 'en')} {' '.join(TOXIC)} loser trash scum clown") for i in range(60)]
    return deobfuscation.fit_letters(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize(
    "shown,plain",
    [("1d10t", "idiot"), ("i d i o t", "idiot"), ("st.u.p-i-d", "stupid"), ("m0r0n", "moron"), ("$cum", "scum"),
     ("tr@sh", "trash"), ("l-o-s-e-r", "loser"), ("cl0wnnnn", "clown"), ("idiiiiot", "idiot")],
)
def test_disguised_words_are_restored(letters, shown, plain):
    assert plain in deobfuscation.token_features(shown, letters)[0]


@pytest.mark.parametrize("shown", ["plain", "it's", "2024", "a@b.example.com/long/path/of/things", "", "...", "x86"])
def test_plain_words_stay(letters, shown):
    assert not deobfuscation.token_features(shown, letters)[1]


@pytest.mark.parametrize(
    "shown,words",
    [("i d i o t m o r o n", {"idiot", "moron"}), ("s t u p i d i d i o t l o s e r", {"stupid", "idiot", "loser"}),
     ("i.d.i.o.t.s.t.u.p.i.d.m.o.r.o.n", {"idiot", "stupid", "moron"}), ("iiiiiiiiii" + "d" * 20 + "10t", {"idiot"}),
     ("m o r o n " * 3000, {"moron"})],
    ids=lambda x: x[:12] if isinstance(x, str) else None,
)
def test_long_disguises_are_restored(letters, shown, words):
    reader = deobfuscation.FeatureReader(letters)
    import pyarrow as pa

    _, features, names, restored = reader.read(pa.array(["of the", f"of the {shown} which"]))
    assert words <= {names[f] for f in features} and restored[0] == 0 and restored[1] >= 1


@pytest.mark.parametrize(
    "shown,words",
    [("idioot", {"idiot"}), ("morron", {"moron"}), ("IDIoOT!", {"idiot"}), ("id.iot", {"idiot"}), ("mo-ron", {"moron"}), ("st.up.id", {"stupid"}),
     ("i d i o t, m o r o n", {"idiot", "moron"}), ("1d10t/m0r0n", {"idiot", "moron"}), ("i  d  i  o  t", {"idiot"}),
     ("i\nd\ni \n o\tt", {"idiot"}), ("i\u00a0d\u00a0i\u00a0o\u00a0t", {"idiot"}), ("s t u p i d \u00e9 t \u00e9", {"stupid"})],
)
def test_every_kind_of_disguise_is_restored(letters, shown, words):
    import pyarrow as pa

    reader = deobfuscation.FeatureReader(letters, dict.fromkeys(TOXIC, 1.0))
    _, features, names, restored = reader.read(pa.array(["of the", f"of the {shown} which"]))
    assert words <= {names[f] for f in features} and restored[1] >= 1


@pytest.mark.parametrize("word", ["loss", "the", "idioot", "sseen", "add", "moorrons", "\u00e9tt\u00e9", "aab", "clloown"])
def test_kept_doubled_letters_are_those_of_the_lattice(letters, word):
    rest = letters._decode(word)
    assert letters.keeps_doubled(word) <= (rest == word)
    if "oorr" not in word:
        assert letters.keeps_doubled(word) == (rest == word)


def test_meant_doubled_letters_stay(letters):
    even = deobfuscation.LetterModel(np.full_like(letters.cost, 1.0))
    names, restored = deobfuscation.token_features("letter", even)
    assert {"letter", "leter"} <= set(names) and not restored and even.restore("letter") == "letter"


def test_all_kinds_are_restored_in_place(letters, frame):
    rows = [(1, "so i  d i\no t, m o r o n! id.iot (1d10t/m0r0n)"), (2, "of the, in\n\nis. which-have")]
    got = {r.doc_id: r.text for r in deobfuscation.deobfuscate(frame(rows), letters).collect()}
    assert got == {1: "so idiot, moron! idiot (idiot/moron)", 2: "of the, in\n\nis. which-have"}


def test_wanted_words_are_found_where_edges_are_not(letters):
    even = deobfuscation.LetterModel(np.full_like(letters.cost, 3.0))
    names = deobfuscation.token_features("s t u p i d i d i o t l o s e r", even, {"idiot": 1.0, "loser": 1.0})[0]
    assert {"idiot", "loser"} <= set(names)


def test_encoded_keys_stay(letters):
    key = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda"
    assert deobfuscation.token_features(key, letters)[1] is False
    assert letters.restore(key) == key


def test_long_texts_are_restored_in_place(letters, frame):
    rows = [(1, "so i d i o t m o r o n l o s e r, of")]
    assert [r.text for r in deobfuscation.deobfuscate(frame(rows), letters).collect()] == ["so idiot moron loser, of"]


def test_decoding_finds_the_cheapest_path(letters):
    """Against all spellings of a short lattice."""
    import itertools

    shown = "1d1o7"
    found = []
    for spelled in itertools.product(*([deobfuscation.STANDS_FOR.get(c, c) for c in shown])):
        x = y = deobfuscation.EDGE
        total = deobfuscation.SIGN_COST * sum(c in deobfuscation.STANDS_FOR for c in shown)
        for c in spelled:
            s = deobfuscation._symbol(c)
            total += letters.cost[x, y, s]
            x, y = y, s
        found.append((total + letters.cost[x, y, deobfuscation.EDGE], "".join(spelled)))
    assert letters._decode(shown) == min(found)[1]


def test_texts_are_restored_in_place(letters, frame):
    rows = [(1, "so 1d10t, l o s e r!"), (2, None), (3, "")]
    got = {r.doc_id: r.text for r in deobfuscation.deobfuscate(frame(rows), letters).collect()}
    assert got == {1: "so idiot, loser!", 2: None, 3: ""}


def test_toxic_texts_are_found_also_in_disguise(letters, frame, clashing):
    draw = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 8 == 0
        rows.append((i, spoken(i, "en") + (f" {draw.choice(TOXIC)} " if toxic else " ") + spoken(i + 1, "en")))
        labels.append((i, int(toxic)))
    labels += [(1, None), (None, 1), (9999, 1), (8, 0)]
    model = deobfuscation.fit_toxicity(frame(rows), frame(labels, "doc_id long, toxic int"), letters)
    new = [(1, "you m0r0n of the in"), (2, spoken(77, "en")), (3, None), (4, ""), (5, "i d i o t"), (5, "i d i o t"), (6, "of " * 90_000 + "stup1d")]
    got = deobfuscation.toxicity(clashing(new), model).collect()
    assert sorted((r.doc_id, r.predicted) for r in got) == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 1), (5, 1), (6, 1)]
    assert all(0 <= r.score <= 1 for r in got)
    assert deobfuscation.toxicity(frame([]), model).count() == 0


def test_without_labels_every_score_is_the_same(letters, frame):
    model = deobfuscation.fit_toxicity(frame([(1, "a b")]), frame([], "doc_id long, toxic int"), letters)
    assert [r.score for r in deobfuscation.toxicity(frame([(1, "idiot"), (2, None)]), model).collect()] == [0.5, 0.5]


def page(i, body, kind="article"):
    menu = "".join(f"<li><a href=/{k}>go {k}</a></li>" for k in range(5))
    return (
        f"<html><head><title>t{i}</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul>{menu}</ul></nav>"
        f"<div class=ad>Buy this now {i}</div><{kind}><h1>Title number {i}.</h1>{body}</{kind}><footer>&copy; site {i}</footer></body></html>"
    )


@pytest.fixture(scope="module")
def page_model(spark):
    rows = [(i, "u", page(i, "".join(f"<p>{spoken(i * 7 + k, 'en', 20)}.</p>" for k in range(i % 5 + 1)))) for i in range(60)]
    return crf_extract.fit(spark.createDataFrame(rows, "page_id long, url string, html string"), sample=60)


def test_article_without_its_surroundings(page_model, spark):
    body = "<p><b>First &amp; bo<i>ld</i> words of the story.<br>More\n  of it.<p>Second &lt;one&gt; goes on here."
    rows = [(1, "u1", page(900, body)), (2, None, page(900, body)), (3, "u", None), (4, "u", ""), (5, "u", "<nav>only</nav>")]
    docs = spark.createDataFrame([(*r, "x") for r in rows + rows[:1]], "page_id long, url string, html string, text string")
    got = crf_extract.extract(docs, page_model).collect()
    want = "Title number 900. First & bold words of the story. More of it. Second <one> goes on here."
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [
        (1, want, len(want)), (1, want, len(want)), (2, want, len(want)), (3, "", 0), (4, "", 0), (5, "", 0),
    ]


def test_pages_without_the_marks_of_an_article(page_model):
    html = page(5, f"<p>{spoken(1, 'en', 30)}.</p><aside>See also this</aside>", "div").replace(
        "<footer>", "<section id=comments><p>Nice story, I liked it very much.</p></section><form><p>Your name please</p></form><footer>"
    )
    text = page_model.main_text(html)
    assert spoken(1, "en", 30) in text
    for other in ("See also", "Nice story", "Your name", "Buy this", "site 5", "go 1"):
        assert other not in text


HEAD = "<html><head><meta charset=utf-8><title>t</title><style>p{}</style><script>'<p>'</script>"


@pytest.mark.parametrize(
    "html",
    [f"{HEAD}<p>Article one.</p>", f"{HEAD}<noscript><img src=x><p>No script.</p></noscript><div>Article one.</div>", f"{HEAD}Article one.",
     f"{HEAD}<link rel=x><a href=y>Article</a> one.", f"{HEAD}<basefont size=2><html lang=en><p>Article one.</p>",
     f"{HEAD}</head><p>Article one.", f"{HEAD}<body><p>Article one.", f"{HEAD}</head><body><p>Article one.</body></html>"],
)
def test_a_head_ends_where_its_end_tag_is_left_out(html):
    assert [b.text for b in crf_extract.blocks_of(html)] == ["Article one."]


def test_pages_without_head_end_and_body_have_the_same_text(page_model):
    html = page(5, f"<p>{spoken(1, 'en', 30)}.</p>")
    assert page_model.main_text(html.replace("</head><body>", "").replace("</body></html>", "")) == page_model.main_text(html) != ""


def test_long_page_is_read_whole(page_model):
    body = "".join(f"<p>{spoken(k, 'en', 30)}.</p>" for k in range(2000))
    text = page_model.main_text(page(1, body))
    assert text.endswith(f"{spoken(1999, 'en', 30)}.") and text.startswith("Title number 1.")


def test_decoding_equals_all_label_sequences():
    import itertools

    draw = np.random.default_rng(3)
    model = crf_extract.PageModel(draw.normal(size=crf_extract.BUCKETS), draw.normal(size=(2, 2)))
    features = [[int(x) for x in draw.integers(0, crf_extract.BUCKETS, 3)] for _ in range(7)]

    def value(labels):
        score = sum(model.weights[f].sum() for f, y in zip(features, labels) if y)
        return score + sum(model.change[a, b] for a, b in zip(labels, labels[1:]))

    assert model.decode(features) == list(max(itertools.product((0, 1), repeat=7), key=value))
    assert model.decode([]) == []


def test_training_raises_the_likelihood():
    pages = [([[1, 2], [3], [1]], [1, 0, 1]), ([[3], [1], [1]], [0, 1, 1])]
    model = crf_extract.train(pages)
    assert [model.decode(x) for x, _ in pages] == [y for _, y in pages]
    assert crf_extract.train([]).decode([[0]]) == [0]


def test_trigram_counts_equal_a_plain_count():
    import pyarrow as pa

    texts = ["", None, " a  b", "é\tÀx", "Zebra", "ab\n\ncd ", "日本 x9y", "q"]
    plain = np.zeros(deobfuscation.SYMBOLS**3, np.int64)
    joined = " ".join(["", "", *[t or "" for t in texts]])
    symbols = [deobfuscation.LETTERS.find(c.lower()) + 1 if c.isascii() else deobfuscation.OTHER for c in joined]
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        if b or c:
            plain[((a if b else 0) * deobfuscation.SYMBOLS + b) * deobfuscation.SYMBOLS + c] += 1
    assert (deobfuscation.trigram_counts(pa.array(texts)) == plain).all()


FIRST = "The first long sentence of this part tells the reader something useful about the matter."
OTHER_TEXT = "Another sentence of it goes on for quite a while and ends with a full stop."
PROSE = "This paragraph has several words and is part of the article that the page is about, as one sees."
HARD_PAGES = [  # html, main text
    (f"<body><nav><ul><li><a href=x>Home</a></li><li><a href=y>About</a></li></ul></nav><article><p>{PROSE}</p><ul><li>{FIRST}</li>"
     f"<li>{OTHER_TEXT}</li></ul><p>{PROSE}</p></article><footer>Copyright</footer></body>", f"{PROSE} {FIRST} {OTHER_TEXT} {PROSE}"),
    (f"<main><ul><li>{FIRST}</li><li>{OTHER_TEXT}</li></ul></main>", f"{FIRST} {OTHER_TEXT}"),
    (f"<main><p>{PROSE}</p><table><tr><td>{FIRST}</td><td>4.5</td></tr></table><blockquote>{OTHER_TEXT}</blockquote></main>",
     f"{PROSE} {FIRST} 4.5 {OTHER_TEXT}"),
    (f'<article class="post related"><p>{PROSE}</p></article>', PROSE),
    (f'<article><div id="share-price-report"><p>{PROSE}</p></div></article>', PROSE),
    (f'<article><div class="login-guide article-body"><p>{PROSE}</p></div></article>', PROSE),
    (f'<article><p>{PROSE}</p></article><div class="comment-list"><article class="comment"><p>{FIRST}</p></article></div>', PROSE),
    (f'<article><p>{PROSE}</p></article><div class="cookie-banner"><p>{FIRST}</p></div>', PROSE),
    (f'<article><p>{PROSE}</p><aside><p>{FIRST}</p></aside></article><div id="related_posts"><p>{FIRST}</p></div>', PROSE),
]


def test_hard_pages(spark):
    import pyarrow.parquet as pq

    pages = [crf_extract.blocks_of(r) for r in pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist()]
    model = crf_extract.train([v for b in pages for v in crf_extract.training_views(b)])
    for html, text in HARD_PAGES:
        assert model.main_text(html) == text, html


@pytest.mark.parametrize("html", ["<div>x" * 50_000, "<b>" * 20_000 + "<p>y</p>" * 20_000, "<b>x</i></div>" * 30_000, '<div class="a b">' * 20_000 + "<p>t</p>" * 20_000])
def test_nesting_costs_no_more_than_flat_text(html):
    import time

    begin = time.perf_counter()
    blocks = crf_extract.blocks_of(html)
    assert len(crf_extract.block_features(blocks)) == len(blocks) >= 20_000
    assert time.perf_counter() - begin < 30
