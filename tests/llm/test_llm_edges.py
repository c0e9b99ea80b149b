"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute
import public_tokenizers
from pyspark.sql import functions as F

from corpusflow.llm import (
    byte_bpe,
    chat,
    components,
    decontamination,
    language_cnn,
    lines,
    main_text,
    maxscore,
    near_duplicates,
    token_counts,
    toxicity,
)

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
DOCS = "doc_id long, text string, lang string, n_lines string, score string, docs string, token string, ids string"


@pytest.fixture(scope="module")
def frame(spark):
    """Documents with columns that carry names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(d, t, "en", "x", "y", "z", "w", "v") for d, t in rows], DOCS)

    return make


WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


# ---- line dedup


def test_lines_hard_cases(frame):
    line, tied = "A line of twenty chars, at least", "é" * 20
    rows = [
        (1, f"{line}\nown\n{line}\nend"), (2, f"\x0b {line.upper()} \t\nx"), (3, f"{line}\n{line}\nlast"), (4, None), (5, ""),
        (6, f"{tied}\n{tied[:19]}"), (7, f"{tied}\n{tied[:19]}"), (8, f"\n{tied}\n{tied[:19]}\n"), (None, line), (9, "É" * 20),
    ]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in lines.dedup_lines(frame(rows)).collect()}
    want = brute.dedup_lines([(-1 if d is None else d, t) for d, t in rows])
    assert got == {None if d == -1 else d: v for d, v in want.items()}
    assert got[3][0] == f"{line}\n{line}\nlast" and got[1] == ("own\nend", 4, 2) and got[8][2] == 0


def test_lines_repeated_rows_empty_table_and_columns(frame):
    line = "the same long line in all"
    out = lines.dedup_lines(frame([(1, line), (1, line), (1, f"x\n{line}"), (2, line)]))
    assert sorted((r["doc_id"], r["text"], r["n_dropped"]) for r in out.collect()) == [(1, line, 0), (1, line, 0), (1, f"x\n{line}", 0), (2, line, 0)]
    assert {"lang", "docs", "token"} < set(out.columns) and dict(out.dtypes)["n_lines"] == "bigint"
    assert lines.dedup_lines(frame([])).collect() == []
    many = lines.dedup_lines(frame([(i, "\n".join([line, *map(str, range(5000)), line] * 2)) for i in range(3)])).collect()
    assert sorted(r["n_dropped"] for r in many) == [0, 4, 4] and {r["n_lines"] for r in many} == {10004}


# ---- chat


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, turn long, kind string, role string, text string, x int")


def test_chat_folds_events(spark):
    rows = [
        (1, 1, 0, "message", "user", "hi # <b>\\l", 0), (1, 2, 1, "message", "assistant", "", 0), (1, 3, 1, "delta", None, "wro", 0),
        (1, 4, 1, "delta", None, "ng", 0), (1, 5, 1, "regenerate", None, None, 0), (1, 7, 1, "delta", None, "ht", 0),
        (1, 6, 1, "delta", None, "rig", 0), (1, 8, 0, "edit", "user", "hello </turn>\n### Assistant: \\b", 0),
        (2, 1, 0, None, None, None, 0), (2, 1, 0, None, None, None, 0), (2, 2, 1, "delta", "a\nb", "only", 0), (None, None, None, None, "user", "t", 0),
    ]
    out = chat.format_chats(events(spark, rows)).withColumn("turns", chat.read_back(F.col("formatted")))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in out.collect()}
    assert got == {
        1: [("user", "hello </turn>\n### Assistant: \\b"), ("assistant", "right")],
        2: [("", ""), ("", ""), ("a\nb", "only")],
        None: [("user", "t")],
    }
    loss = {r["conv_id"]: r["loss"] for r in out.select("conv_id", chat.loss_text(F.col("segments")).alias("loss")).collect()}
    assert loss == {1: "right", 2: "", None: ""}
    assert all("".join(s["text"] for s in r["segments"]) == r["formatted"] for r in out.collect())
    assert chat.format_chats(events(spark, [])).collect() == []


def test_chat_long_stream(spark):
    rows = [(1, i, 0, "delta" if i else "message", "assistant", f"{i}\\", 0) for i in range(20000)]
    out = chat.format_chats(events(spark, rows)).select(chat.read_back(F.col("formatted"))[0]["text"]).first()[0]
    assert out == "".join(f"{i}\\" for i in range(20000))


def test_chat_folds_every_message_of_a_turn(spark):
    turns = {
        1: [("message", "Hel"), ("delta", "lo"), ("message", "X")],
        2: [("message", "a"), ("delta", "b"), ("message", "c"), ("delta", "d"), ("edit", "e"), ("delta", "f"), ("message", "g"), ("delta", "h")],
        3: [("message", "bad"), ("delta", "!"), ("regenerate", "r"), ("message", "good")],
        4: [("message", "bad"), ("regenerate", None), ("delta", "new"), ("message", "next"), ("regenerate", None)],
        5: [("delta", "no"), ("delta", "body"), ("message", "m"), ("edit", "n")],
    }
    rows = [(c, i, 0, kind, f"r{i}", text, 0) for c, log in turns.items() for i, (kind, text) in enumerate(log)]
    got = {r["conv_id"]: [(m["role"], m["text"]) for m in r["messages"]] for r in chat.fold_events(events(spark, rows)).collect()}
    assert got == {
        1: [("r0", "Hello"), ("r2", "X")],
        2: [("r0", "ab"), ("r2", "ef"), ("r6", "gh")],
        3: [("r0", ""), ("r3", "good")],
        4: [("r0", "new"), ("r3", "")],
        5: [("r0", "nobody"), ("r2", "n")],
    }


def test_chat_many_streamed_messages(spark):
    rows = [(1, i, 0, "delta" if i % 2 else "message", "assistant", str(i), 0) for i in range(20000)]
    out = chat.fold_events(events(spark, rows)).first()["messages"]
    assert [m["text"] for m in out] == [f"{i}{i + 1}" for i in range(0, 20000, 2)]


# ---- byte-level BPE


def test_bpe_round_trip_and_long_texts(frame):
    texts = [None, "", " ", "a" * 3000, "\x00\U0001f600 ß  \n\n x", "<|endoftext|>", prose(1, 200_000), "中" * 2000 + " " + "é's " * 100_000]
    out = byte_bpe.decode(byte_bpe.encode(frame(list(enumerate(texts))), "text", "ids", *RANKS), "ids", "raw", *RANKS)
    library = byte_bpe.encoding(*RANKS)
    for r in out.collect():
        assert bytes(r["raw"]).decode() == (texts[r["doc_id"]] or "")
        assert r["ids"] == library.encode_ordinary(texts[r["doc_id"]] or "")
    assert byte_bpe.encode(frame([]), "text", "ids", *RANKS).collect() == []
    assert byte_bpe.decode(frame([(1, "x")]).select(F.lit(None).cast("array<int>").alias("ids")), "ids", "raw", *RANKS).first()["raw"] == b""


def test_bpe_cuts_are_safe():
    library = byte_bpe.encoding(*RANKS)
    rnd = random.Random(3)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "B", "1", " ", "  ", "\n", "'s", "é", "!", "　", "\t"]) for _ in range(60))
        pieces = list(byte_bpe.safe_pieces(text, 5))
        assert "".join(pieces) == text and [i for p in pieces for i in library.encode_ordinary(p)] == library.encode_ordinary(text)


# ---- token counts


def test_token_counts_hard_cases(frame, monkeypatch):
    from tokenizers import Tokenizer

    texts = [None, "", "  a  <|endoftext|>  b's ''s 　", "<|endoftext|>" * 3, "x" * 5000, "Ᲊᲊ Ɤ1", prose(2, 100_000), "I'll we're\r\n\t 12²Ⅷ"]
    library = Tokenizer.from_file(JSON)
    want = {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)}
    docs = frame(list(enumerate(texts)))
    assert {r[0]: (r[1], r[2]) for r in token_counts.count_tokens(docs, JSON).collect()} == want
    monkeypatch.setattr(token_counts, "FREQUENT", 0)  # every pre-token by the shuffle
    assert {r[0]: (r[1], r[2]) for r in token_counts.count_tokens(docs, JSON).collect()} == want
    twice = token_counts.count_tokens(frame([(1, "one two"), (1, "one two"), (None, "x")]), JSON).collect()
    assert {r[0]: r[2] for r in twice} == {1: 4, None: 1}
    assert token_counts.count_tokens(frame([]), JSON).collect() == []


def test_pre_tokens_as_the_library():
    from tokenizers.pre_tokenizers import ByteLevel

    rule, rnd = ByteLevel(add_prefix_space=False), random.Random(7)
    parts = ["a", "s", "'", "'s", "'ll", " ", "  ", "\n", "1", "²", "é", "中", "!", "?", "\x1c", "\x85", "　", "​", "😀", "́", "Ᲊ"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        start = token_counts.split(np.frombuffer(text.encode("utf-32-le"), "<u4"), np.array([0, len(text)])).tolist()
        assert [text[a:b] for a, b in zip(start, [*start[1:], len(text)])] == [text[a:b] for _, (a, b) in rule.pre_tokenize_str(text)]


# ---- near duplicates


def near_rows():
    rows = [(i, None) for i in (900, 901)] + [(902, ""), (903, " \t"), (904, "two words"), (905, "Two  WORDS"), (906, "two words more")]
    base = prose(11, 200).split()
    rnd = random.Random(5)
    for i in range(60):  # near copies of one text, most of them less alike among each other
        own = list(base)
        for at in rnd.sample(range(200), 5):
            own[at] = f"new{i}_{at}"
        rows.append((1000 + i, " ".join(own)))
    rows += [(2000 + i, prose(11, 200)) for i in range(40)]  # exact copies
    shared = prose(12, 60)
    rows += [(3000 + i, shared + " " + prose(100 + i, 60)) for i in range(40)]  # a common passage
    return rows + [(10, prose(13, 30_000)), (11, prose(13, 30_000) + " end")]


@pytest.mark.parametrize("few", [32, 1])
def test_near_duplicates_hard_cases(frame, monkeypatch, few):
    monkeypatch.setattr(near_duplicates, "FEW", few)
    monkeypatch.setattr(near_duplicates, "BLOCK", 7)
    monkeypatch.setattr(near_duplicates, "ROUNDS", 1)
    rows = near_rows()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates(frame(rows), shingle=4).collect()}
    assert got == brute.near_duplicates(rows, 4)


def test_near_duplicates_ids_and_empty_table(frame):
    a, b = prose(20, 50), prose(21, 50)
    rows = [(5, a), (5, b), (7, b), (3, a), (None, a), (8, "z"), (8, "z")]
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in near_duplicates.near_duplicates(frame(rows)).collect())
    assert got == [(0, 0), (3, 3), (5, 3), (5, 3), (7, 3), (8, 8), (8, 8)]
    assert near_duplicates.near_duplicates(frame([])).collect() == []


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (7, None)]
    parent = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for x, y in edges:
        if y is not None and x != y:
            a, b = root(x), root(y)
            parent[max(a, b)] = min(a, b)
    got = components.connected_components(spark.createDataFrame(edges, "x long, y long")).collect()
    assert sorted((r["node"], r["component"]) for r in got) == sorted((x, root(x)) for x in parent)
    assert components.connected_components(spark.createDataFrame([], "x long, y long")).collect() == []


# ---- decontamination


def test_contained_items(frame, spark):
    items = [(i, prose(50 + i, n)) for i, n in enumerate([3, 5, 9, 14, 40, 60])] + [(6, None), (7, ""), (8, "?!"), (None, prose(70, 20))]
    rows = [(1, None), (2, ""), (3, items[0][1])]
    rows += [(10 + i, f"{prose(200 + i, 300)}. {t.upper()}, {prose(300 + i, 2000)}") for i, t in items if i is not None and t]
    rows += [(100 + i, f"{prose(400 + i, 50)} {' '.join(t.split()[:-3])} {prose(500 + i, 50)}") for i, t in items[2:6]]  # cut short
    rows += [(200, f"{items[4][1][: len(items[4][1]) // 2]} {prose(600, 900)} {items[5][1]} {items[9][1]}"), (201, prose(601, 50_000))]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, size int")
    got = {(r["doc_id"], r["item_id"]): (r["n_common"], r["n_item"]) for r in decontamination.contained_items(frame(rows), table).collect()}
    assert got == brute.contained(rows, items) and (200, 5) in got and (200, None) in got and (3, 0) in got
    assert decontamination.contained_items(frame([]), table).collect() == []
    assert decontamination.contained_items(frame(rows), table.limit(0)).collect() == []
    twice = decontamination.contained_items(frame([(1, items[3][1])] * 2), table.union(table)).collect()
    assert [(r["doc_id"], r["item_id"]) for r in twice] == [(1, 3)]


# ---- search


def exact(rows, queries, k):
    out = []
    for q, v in queries:
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("width", [1, 7, 64])
def test_top_k(spark, monkeypatch, width):
    monkeypatch.setattr(maxscore, "SHARD", 100)
    monkeypatch.setattr(maxscore, "BLOCK", 10)
    rng = np.random.default_rng(width)
    rows = [(int(i), [int(x) for x in rng.integers(-3, 4, width)]) for i in range(400)] + [(1000 + i, [2] * width) for i in range(50)]
    more = [(2000, None), (2001, [None] * width), (2002, [float("nan")] * width), (None, [1] * width)]
    table = spark.createDataFrame([(i, v and [None if x is None else float(x) for x in v], "x") for i, v in rows + more], "vec_id long, vector array<double>, score string")
    got = maxscore.top_k(table, table.where("vec_id % 20 = 0"), 20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == exact(rows, [r for r in rows if r[0] % 20 == 0], 20)


def test_top_k_small_tables(spark):
    schema = "vec_id long, vector array<long>"
    two = spark.createDataFrame([(0, [1, 2]), (1, [3]), (20, [])], schema)
    got = sorted(tuple(r) for r in maxscore.top_k(two, two.where("vec_id % 20 = 0"), 20).select("query_id", "rank", "vec_id", "score").collect())
    assert got == [(0, 1, 1, 3), (0, 2, 20, 0), (20, 1, 0, 0), (20, 2, 1, 0)]
    nothing = spark.createDataFrame([], schema)
    assert maxscore.top_k(nothing, nothing).collect() == [] and maxscore.top_k(nothing, two).collect() == []
    hollow = spark.createDataFrame([(0, []), (5, [])], schema)
    assert [tuple(r) for r in maxscore.top_k(hollow, hollow.where("vec_id = 0"), 3).collect()] == [(0, 1, 5, 0)]


def test_top_k_repeated_ids(spark, monkeypatch):
    rows = [(1, [9])] * 25 + [(1, [3]), (1, [8])] + [(i, [i % 5]) for i in range(2, 40)] + [(20, [1])] * 2
    queries = [(20, [1])] * 3 + [(20, [-1]), (40, [2])]
    schema = "vec_id long, vector array<long>"
    for shard in (4096, 7):
        monkeypatch.setattr(maxscore, "SHARD", shard)
        monkeypatch.setattr(maxscore, "BLOCK", min(shard, 2) if shard < 4096 else 1024)
        got = maxscore.top_k(spark.createDataFrame(rows, schema), spark.createDataFrame(queries, schema), 30).collect()
        want = []
        for q in (20, 40):
            pairs = sorted((-v[0] * w[0], i) for own, v in queries for i, w in rows if own == q != i)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(pairs[:30])]
        assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == want
        assert [r["vec_id"] for r in got if r["query_id"] == 40].count(1) == 26


@pytest.mark.parametrize("size", [1 << 20, 1 << 28, 1 << 34])
def test_top_k_scores_beyond_doubles(spark, monkeypatch, size):
    """Products past 2 ** 53 are exact, and past 2 ** 63 where they cancel out."""
    monkeypatch.setattr(maxscore, "SHARD", 100)
    rng = np.random.default_rng(size % 97)
    width = 12
    rows = [(i, [int(x) for x in rng.integers(-size, size, width)]) for i in range(300)]
    rows += [(400 + i, [x + (j == 3) * i for j, x in enumerate(rows[7][1])]) for i in range(30)]
    if size > 1 << 30:
        # Neighbouring components cancel out, so that scores stay within 64 bits.
        rows = [(i, [v[j - j % 2] if i % 20 == 0 else v[j - j % 2] * (-1) ** j + j % 2 * (v[j] % 1000) for j in range(width)]) for i, v in rows]
    candidates, queries = [r for r in rows if r[0] % 20], [r for r in rows if r[0] % 20 == 0]
    tables = [spark.createDataFrame([(i, [float(x) for x in v]) for i, v in some], "vec_id long, vector array<double>") for some in (candidates, queries)]
    got = maxscore.top_k(*tables, 20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == exact(candidates, queries, 20)


def test_top_k_deals_a_hot_id_out(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 100)

    def watched(k):
        def sizes(candidates, queries):
            import pyarrow as pa

            return pa.table([pa.array([candidates.num_rows])] * 3, ["query_id", "id", "score"])

        return sizes

    monkeypatch.setattr(maxscore, "_search", watched)
    hot = spark.createDataFrame([(7, [1])] * 2000, "vec_id long, vector array<long>")
    sizes = [r["query_id"] for r in maxscore.top_k(hot, hot.limit(1), 20).collect()]
    assert len(sizes) > 10 and max(sizes) < 200


# ---- classifiers


def test_language_hard_cases(frame, spark):
    own = {"aa": "the cat sat on the mat", "bb": "der hund und die katze"}
    rows = [(i, f"{own[x]} {i}", x) for i, x in enumerate(["aa", "bb"] * 30)] + [(90, None, "aa"), (91, "no label", None)]
    model = language_cnn.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.names == ["aa", "bb"]
    docs = frame([(1, own["aa"]), (1, own["aa"]), (2, own["bb"]), (3, None), (4, ""), (5, "12 !?"), (6, "中文"), (7, own["bb"] * 20_000)])
    got = {(r["doc_id"], r["lang_pred"]) for r in language_cnn.identify(docs, model).collect()}
    assert got - {(6, "aa"), (6, "bb")} == {(1, "aa"), (2, "bb"), (3, "und"), (4, "und"), (5, "und"), (7, "bb")}
    out = language_cnn.identify(docs, model)
    assert out.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"] and out.where("score < 0 or score > 1").count() == 0
    nothing = language_cnn.learn(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert [r["lang_pred"] for r in language_cnn.identify(docs.limit(1), nothing).collect()] == ["und"]
    assert language_cnn.identify(frame([]), model).collect() == []


def test_toxicity_hard_cases(frame, spark):
    rows = [(i, prose(i, 40) + (" vileword nasty" if i % 3 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "x") for i in range(300)] + [(None, 1, "x"), (5000, 1, "x"), (1, None, "x"), (2, 7, "x")], "doc_id long, toxic int, text string")
    model = toxicity.learn(frame(rows), labels)
    docs = frame([(1, "Nasty, vileword! " + prose(900, 30)), (1, "Nasty, vileword! " + prose(900, 30)), (2, prose(901, 40)), (3, None), (4, ""), (5, prose(902, 100_000)), (6, prose(902, 100_000) + " vileword nasty")])
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1}
    out = toxicity.score(docs, model)
    assert set(out.columns) == {*docs.columns, "predicted"} and dict(out.dtypes)["score"] == "double"
    for some in (labels.limit(0), labels.where("toxic = 0")):
        plain = toxicity.score(docs, toxicity.learn(frame(rows), some)).collect()
        assert {r["predicted"] for r in plain} == {0} and all(0 <= r["score"] <= 1 for r in plain)
    assert toxicity.score(frame([]), model).collect() == []


# ---- main text


PAGE = (
    "<html><head><title>T &amp; t</title><style>p > b{}</style></head><body><header>Site head</header><nav><ul><li><a href='/a>b'>Home</a>"
    "<li><a href=x>News</a></ul></nav><div class='cookie notice'>We use cookies</div><main><header><h1>The  big\n title</h1></header><p>First &eacute;l&eacute;ment with"
    " many plain words in it<!-- hidden > --> and <b>bold <i>text</i></b><br>here.<p>Second paragraph that has some more words &lt;here&gt; too"
    "<script>if (a<b) document.write('<p>no</p>')</script><aside>Side note words</aside><form><input><button>Send</button></form>"
    "<ul><li>A list item of the article<li>Another item of the article</ul><div id=comments><p>Reader words</p></div></main>"
    "<footer>Foot words of the page</footer></body></html>"
)


def test_main_text_of_other_pages(spark):
    pages = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (3, "", "x"), (4, "plain words only", "x"), (5, PAGE, "x"), (5, PAGE, "x"), (6, "<p>" * 5000 + "deep", "x")], "page_id long, html string, text string")
    want = "The big title\nFirst élément with many plain words in it and bold text here.\nSecond paragraph that has some more words <here> too\nA list item of the article\nAnother item of the article"
    for known in (main_text.learn(pages), {}):
        got = main_text.extract(pages, known)
        assert got.columns == ["page_id", "html", "text"] and got.count() == 7
        texts = {r["page_id"]: r["text"] for r in got.collect()}
        assert texts[2] == texts[3] == "" and texts[4] == "plain words only"
    learned = {r["page_id"]: r["text"] for r in main_text.extract(pages, main_text.learn(pages)).collect()}
    assert learned[1] == learned[5] == want
    assert main_text.learn(pages.limit(0)) == {} and main_text.extract(pages.limit(0), {}).collect() == []


def test_main_text_keeps_what_holds_the_page():
    words = "Many plain words of the article that are read by all"
    for around in ("<body class='home no-sidebar'>{}</body>", "<body class='menu'>{}</body>", "<main class='has-sidebar share'>{}</main>",
                   "<article class='post share'>{}</article>", "<html id=widget><div class='widget'><section role=banner>{}</section></div></html>",
                   "<div class='x widget-area'>{}</div>"):
        page = around.format(f"<p>{words}</p><div class='a ad'>Buy this</div><p>{words}</p>")
        assert main_text.main_text(page, {}) == f"{words}\n{words}"
    # The region begins inside an advert that ends before the region does, and the advert is left out all the same.
    assert main_text.main_text(f"<div class=ad><b>{words} {words}</b></div><p>{words} {words} {words}</p>", {}) == " ".join([words] * 3)


def test_main_text_keeps_a_deep_header():
    words = "plain words of the article that all of them read"
    page = "<article>" + "<div>" * 12 + f"<header><h1>{words}</h1></header><p>{words} {words}</p>" + "</div>" * 12 + "</article>"
    assert main_text.main_text(page, {}) == f"{words}\n{words} {words}"
    assert main_text.main_text(f"<header>{words}</header>", {}) == ""


@pytest.mark.parametrize("page", ["<a href=\"" * 40_000, "<!--" * 100_000, "<script>" * 60_000, "<ul><li>x" * 40_000, "</p" * 100_000, "<b> " * 100_000, "<" * 200_000])
def test_main_text_is_linear(page):
    import time

    begin = time.time()
    main_text.main_text(page, {})
    assert time.time() - begin < 5


# ---- byte BPE on white space


def test_long_white_space(frame, spark):
    """Runs of white space of any length; the library's matcher gives up on them."""
    import tiktoken

    library = byte_bpe.encoding(*RANKS)
    short = ["x" + w * n + y for w in (" ", "\n", "\t \u3000", "\x85") for n in (3, 40) for y in ("", "y", "'s", "\x1cz", "1")]
    for text in short:
        ids = [i for part, one in byte_bpe.split_text(text, 8, 4) for i in (library._encode_single_piece(part.encode()) if one else library.encode_ordinary(part))]
        assert ids == library.encode_ordinary(text), text
    long = ["x" + " " * 3_000_000 + "y", "\n" * 2_000_000, "a b " + "\t\n " * 700_000 + "c" + " " * 20_000 + "\n", "q" * 300_000, " " * 16_384]
    table = spark.createDataFrame([(i, t, "own") for i, t in enumerate(long)], "doc_id long, text string, IDS string")
    out = byte_bpe.encode(table, "text", "ids", *RANKS, decoded="Raw")
    assert out.columns == ["doc_id", "text", "ids", "Raw"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert all(bytes(got[i]["Raw"]).decode() == t for i, t in enumerate(long))
    assert got[0]["ids"] == library.encode_ordinary("x") + library._encode_single_piece(b" " * 2_999_999) + library.encode_ordinary(" y")
    assert got[3]["ids"] == library.encode_ordinary(long[3])
    none = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.encode(none, "text", "ids", *RANKS, decoded="raw").count() == byte_bpe.decode(none.selectExpr("array(1) as ids"), "ids", "raw", *RANKS).count() == 0


# ---- the classifiers' batched passes against plain ones


def test_toxicity_forward_pass():
    """Words, filters and pooling written out window by window."""
    rng = np.random.default_rng(1)
    params = toxicity._initial([], np.zeros(0, np.int64), rng)
    params = {k: rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in params.items()}
    params["embedding"][0] = 0
    model = toxicity.Model(params, np.array([0.1, -0.2, 0.3, 0.0, 0.2]))
    texts = [rng.integers(1, toxicity.BUCKETS, (n, 3)) for n in (1, 2, 3, 50, 5000)]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    language = np.array([0, 1, 2, 3, 4])
    got = model.scores(np.concatenate(texts), first, language)
    for i, words in enumerate(texts):
        vectors = [sum(params["embedding"][b].astype(float) for b in word) for word in words] + [np.zeros(toxicity.DIMENSIONS)] * 2
        pooled = []
        for w in toxicity.WIDTHS:
            kernel = params[f"w{w}"].reshape(w, toxicity.DIMENSIONS, toxicity.FILTERS)
            windows = [sum(vectors[at + j] @ kernel[j] for j in range(w)) for at in range(len(words))]
            pooled.append(np.max(windows, axis=0))
        hidden = np.maximum(np.concatenate(pooled) + params["bias"], 0)
        logit = hidden @ params["out"] + params["out_bias"][0] - model.thresholds[language[i]]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-logit)), rel=1e-3, abs=1e-5)


def test_language_forward_pass():
    rng = np.random.default_rng(2)
    size = len(language_cnn.WIDTHS) * language_cnn.FILTERS
    shapes = {"embedding": (language_cnn._CLASSES, language_cnn.DIMENSIONS), "out": (size, 3), "bias": (3,)}
    shapes |= {f"w{w}": (w * language_cnn.DIMENSIONS, language_cnn.FILTERS) for w in language_cnn.WIDTHS}
    params = {k: rng.normal(0, 0.4, v).astype(np.float32) for k, v in shapes.items()}
    model = language_cnn.Model(["a", "b", "c"], params)
    windows = rng.integers(0, 40, (6, language_cnn.WINDOW)).astype(np.uint8)
    got = model.probabilities(windows, model.tables())
    for i, window in enumerate(windows):
        vectors = params["embedding"][window].astype(float)
        pooled = []
        for w in language_cnn.WIDTHS:
            kernel = params[f"w{w}"].reshape(w, language_cnn.DIMENSIONS, language_cnn.FILTERS)
            answers = [sum(vectors[at + j] @ kernel[j] for j in range(w)) for at in range(len(window) - w + 1)]
            pooled.append(np.max(answers, axis=0))
        logits = np.concatenate(pooled) @ params["out"] + params["bias"]
        want = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        assert got[i] == pytest.approx(want, rel=1e-3, abs=1e-5)


def test_a_toxic_passage_late_in_a_long_text(spark):
    """It counts in learning and in calibration, however long the text."""
    rows, labels = [], []
    for i in range(400):
        words = prose(i, 9000 if i % 8 == 0 else 60)
        rows.append((i, words + (" vileword nasty" if i % 4 == 0 else "")))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    fresh = [(1, prose(900, 60)), (2, prose(901, 20_000) + " nasty vileword"), (3, prose(902, 20_000)), (4, "vileword nasty " + prose(903, 60))]
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(spark.createDataFrame(fresh, "doc_id long, text string"), model).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 1}


def test_every_language_is_learned(spark):
    """More languages than any list of the most frequent would hold."""
    alphabets = {f"l{i:03d}": [chr(0x4E00 + 16 * i + j) for j in range(16)] for i in range(250)}
    rnd = random.Random(3)
    rows = [(n * 4 + k, "".join(rnd.choice(a) for _ in range(60)), name) for n, (name, a) in enumerate(alphabets.items()) for k in range(4)]
    model = language_cnn.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.names == sorted(alphabets)


def test_names_in_another_case(spark):
    docs = spark.createDataFrame([(1, "some words of a text", "x", "y", "z")], "doc_id long, text string, Score string, PREDICTED string, Lang_Pred string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.learn(docs, labels)).select("score", "predicted").count() == 1
    learned = language_cnn.learn(docs.withColumn("lang", F.lit("en")))
    assert language_cnn.identify(docs, learned).select("score", "lang_pred").count() == 1


def test_items_of_few_words(spark):
    """Found inside longer documents at their own length, against the plain version."""
    rnd = random.Random(8)
    docs = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(12)))) for i in range(150)] + [(900, None), (901, "secret code alpha in a longer text")]
    items = [(1, "a b"), (2, "Secret-code alpha"), (3, "h"), (4, "a b c d"), (5, "a b c d e f"), (6, ""), (7, None), (8, "zz")]
    frames = [spark.createDataFrame(rows, f"{key} long, text string") for rows, key in ((docs, "doc_id"), (items, "item_id"))]
    got = {(r["doc_id"], r["item_id"]): (r["n_common"], r["n_item"]) for r in decontamination.contained_items(*frames).collect()}
    assert got == brute.contained(docs, items) and (901, 2) in got


def test_private_names_of_lines(spark):
    docs = spark.createDataFrame([(i, "a line that many documents hold\nown", "x", "y", "z", "q") for i in range(3)], "doc_id long, text string, _doc string, _VERSION string, _dropped string, N_Lines string")
    got = lines.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "_doc", "_VERSION", "_dropped", "n_lines", "n_dropped"]
    assert sorted((r["doc_id"], r["n_dropped"], r["_doc"], r["_VERSION"], r["_dropped"]) for r in got.collect()) == [(0, 1, "x", "y", "z"), (1, 1, "x", "y", "z"), (2, 0, "x", "y", "z")]


def test_toxicity_learns_from_every_label(spark, monkeypatch):
    """More labelled texts than one part takes: all train or calibrate, the parts' models become one, and a rerun gives the same."""
    rows = spark.range(8000).selectExpr("id as doc_id", "concat('word', id % 97, ' text', if(id % 7 = 0, ' vileword', '')) as text", "if(id % 7 = 0, 1, 0) as toxic")
    with monkeypatch.context() as patched:
        patched.setattr(toxicity, "fit", lambda found, *more: found.groupBy("label").count().collect())
        assert {r["label"]: r["count"] for r in toxicity.learn(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))} == {0: 6857, 1: 1143}
    monkeypatch.setattr(toxicity, "ROWS_PER_PART", 200)
    some = rows.where("doc_id < 1500")
    models = [toxicity.learn(some.select("doc_id", "text"), some.select("doc_id", "toxic")) for _ in range(2)]
    fresh = spark.createDataFrame([(1, "word3 text"), (2, "another vileword here"), (3, "")], "doc_id long, text string")
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(fresh, models[0]).collect()} == {1: 0, 2: 1, 3: 0}
    assert all((models[0].params[k] == models[1].params[k]).all() for k in models[0].params)
