import time

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import language, text, times, tokens, vectors
from corpusflow.functions.markdown import convert, html_to_markdown


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<p>Rain <strong>fell</strong> <a href='https://w.test/r'>all night</a>, then</p>", "Rain **fell** [all night](https://w.test/r), then"),
        ("<ul><li>oak</li><li>elm</li></ul>", "* oak\n* elm"),
        ("<h3>Trees</h3><h4>Oaks</h4><p>They grow.</p>", "### Trees\n\n#### Oaks\n\nThey grow."),
        ("<p><b>one <b>word</b> more</b> x</p>", "**one word more** x"),
        ("<p><b> </b> a<i></i> b</p>", "a b"),
        ("<ul>" + "<li>x<ul>" * 3 + "<li>y", "* x\n  * x\n    * x\n      * y"),
        ("<ol><li>a<ul><li>x<li>y</ul><li>b</ol>", "1. a\n   * x\n   * y\n2. b"),
        ("<p>one<p>two <em>three", "one\n\ntwo _three_"),
        ("a<script>var x = '<p>';</script><style>p{}</style><!-- no -->b", "ab"),
        ("<head><title>t</title></head><body>b &amp; &#233; &eacute;</body>", "b & é é"),
        ("<pre>a  b\n  c</pre>", "```\na  b\n  c\n```"),
        ("<blockquote><p>q<br>r</p></blockquote>", "> q  \n> r"),
        ("<p>x <b> bold </b>y</p>", "x **bold** y"),
        ("<img alt='A' src='a.png'>", "![A](a.png)"),
        ("<a name='x'>t</a> 1 < 2", "t 1 < 2"),
        ("", ""),
        ("<p>a</p>b <i", "a\n\nb <i"),
        ("<p>a</p>b <!-- c", "a\n\nb"),
        ("a<!-- <p>b</p> c", "a"),
        ("a<script>'</p>' b", "a"),
    ],
)
def test_markdown(source, expected):
    assert convert(source) == expected


@pytest.mark.parametrize("piece", ['<a "', "<a '", "<", "<!-- ", "<b>", "<script>", "&", "<li>x", "</b>", '<a href="x>', "<b> ", "<b>x", "<ul><li>x", "<blockquote>x", "<b><i>x"])
def test_markdown_takes_linear_time(piece):
    begin = time.perf_counter()
    assert len(convert(piece * 20000)) < 100 * 20000
    convert(piece * 20000 + ">")
    assert time.perf_counter() - begin < 5


def test_markdown_column(values):
    assert values(["<p>a</p>", None, ""], html_to_markdown) == ["a", None, ""]


def test_link_count(values):
    cases = {
        "no links": 0,
        "[a](b)": 1,
        "[a](b) and [c](d)": 2,
        "[](x) [y]()": 2,
        "[a](b) [broken](": 1,
        "`[a](b)` [c](d)": 2,
    }
    assert values(list(cases), text.link_count) == list(cases.values())


def test_language_heuristic(values):
    texts = [
        "This is an English sentence.",
        "Le chat est sur la table avec les autres dans une maison.",
        "Bonjour, je suis un document en français. Il y a beaucoup de mots pour les tests.",
        "le chat",
        "",
    ]
    assert values(texts, language.heuristic) == ["en", "fr", "fr", "en", "en"]
    assert values(["des "], language.french_hits) == [2]


def test_language_profile(spark):
    df = spark.createDataFrame(
        [("the cat and the dog",), ("der Hund und die Katze",), ("el perro y los gatos",), ("zzz 123",)], "t string"
    )
    assert [r.detected for r in language.with_profile(df, "t").collect()] == ["english", "german", "spanish", None]


def test_measures(values):
    assert values(["é\n\n", ""], text.byte_size) == [4, 0]
    assert values(["a\nb\n", "", "x"], text.line_count) == [3, 1, 1]


def test_embedding_input(values):
    assert values(["\n a\nb  c  \n", "  "], text.embedding_input) == ["a b  c", ""]
    assert values(["", " ", None], text.is_embeddable) == [False, True, False]


def test_base64(values):
    assert values(["RsO8b\nmYgRsO8w59l", "no base64 at all?"], text.decoded_base64) == ["Fünf Füße", None]


def test_tokens_are_lossless(values):
    samples = ["Grass, rain & 90210", "  \t\n x", "é—ß 日本 🎉\r\n", "a_b.c(d)", "...", "\x00\x01"]
    assert values(samples, lambda c: F.array_join(tokens.tokens(c), "")) == samples
    assert values(["one two"], tokens.token_count) == [2]


def test_tokenizer_names():
    assert tokens.resolve_tokenizer("P50K_base") == "p50k_base"
    assert tokens.resolve_tokenizer("other") == tokens.resolve_tokenizer(None) == "cl100k_base"


def test_times(values):
    stored = ["2023-01-01T10:30:00Z", "2023-01-01 10:30:00", "2023-01-01T12:30:00+02:00", "yesterday", None]
    parsed = values(stored, lambda c: times.format_utc(times.parse_stored_time(c)))
    assert parsed == ["2023-01-01T10:30:00Z"] * 3 + [None, None]
    assert values(["2021-07-09T06:05:00", "31 May, noon"], lambda c: times.parse_post_time(c).isNull()) == [False, True]


def test_vectors(values):
    given = [[0.5, -1.25], [], None]
    for encode in (vectors.to_text, vectors.to_bracket_text):
        assert values(given, lambda c, e=encode: vectors.from_text(e(c)), "array<float>") == given
    assert values(["[[0.1 0.2]]", "[0.1, 0.2]"], lambda c: F.size(vectors.from_text(c))) == [2, 2]
    dims = {2: "two"}
    assert values(given, lambda c: vectors.dimension_error(c, dims), "array<float>") == [
        None, "ErrUnsupportedEmbeddingDim", "ErrNoEmbeddingVector",
    ]
    assert values([[1.0, 2.0], [1.0]], lambda c: vectors.by_dimension(c, dims)["two"], "array<float>") == [[1.0, 2.0], None]


def test_markdown_holds_few_texts_of_a_batch():
    import tracemalloc

    import pyarrow as pa

    from corpusflow.functions import markdown

    batch = pa.array([f"<p>{'word ' * 4000}{i}</p>" for i in range(200)] + [None])
    tracemalloc.start()
    out = markdown.converted(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out[7].as_py().endswith("word 7") and out[200].as_py() is None
    # All texts are 4 MB, and as much again when converted.
    assert peak < 1_000_000


def test_language_heuristic_lowers_a_text_once_and_reads_all_of_it(values):
    from pyspark.sql import functions as F

    start = "x" * 2046
    texts = [start + "le la du ", start + "xxLE LA xx", start * 3 + "OÙ AU DU ", "le la " + start + "du ", None, ""]
    assert values(texts, language.heuristic) == ["fr", "en", "fr", "fr", "en", "en"]
    assert values(texts, language.french_hits) == [3, 2, 3, 3, None, 0]
    for made in (language.heuristic, language.french_hits):
        assert str(made(F.col("text"))).count("lower(") == 1


def test_language_heuristic_searches_each_word_once(values):
    import random

    from corpusflow import fixed

    long = "the la  LE garden\tun house\n" * 3000 + "la"
    [found] = values([long], lambda c: language._said_once(c))
    assert sorted(found.split(" ")) == sorted(["the", "la", "", "LE", "garden\tun", "house\nthe", ""])
    draw = random.Random(3)
    texts = ["".join(draw.choice(["le", "Des", "où", "x", "qui", " ", " ", "\n", "  ", "İ", "au"]) for _ in range(draw.choice([3, 9, 30]))) for _ in range(300)]
    hits = [sum(word in text.lower() for word in fixed.FRENCH_INDICATORS) for text in texts]
    assert values(texts, language.heuristic) == ["fr" if n >= fixed.FRENCH_THRESHOLD else "en" for n in hits]
    assert {n >= fixed.FRENCH_THRESHOLD for n in hits} == {True, False}
