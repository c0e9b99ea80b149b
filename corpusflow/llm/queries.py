"""Queries over the training-data tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.checks.registry import Query
from corpusflow.llm import (
    byte_bpe,
    chat,
    decontamination,
    language_cnn,
    lines,
    main_text,
    maxscore,
    mixing,
    near_duplicates,
    phrases,
    runs,
    token_counts,
    toxicity,
)
from corpusflow.llm.training import held_out

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def utf8_sha256(text) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    "op1_top_k_search",
    """
    with clean as (
        select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
        where vec_id is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
        select q.vec_id as query_id, c.vec_id as vec_id,
               list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
        from clean q join clean c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
    )
    select query_id, rank, vec_id, score from (
        select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
    ) where rank <= 20
    """,
)
def op1_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one, by whole-number inner product."""
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding").where(maxscore.finite(F.col("embedding")))

    def floored(x: Column) -> Column:
        # From 2 ** 53 on every double is whole, and `floor` as a long would end at 2 ** 63.
        scaled = F.lit(64.0) * x.cast("double")
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    whole = F.transform("embedding", floored)
    candidates = vectors.select("vec_id", whole.alias("vector"))
    return maxscore.top_k(candidates, candidates.where(F.col("vec_id") % 20 == 0), 20)


@query("op2_language")
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = language_cnn.learn(docs.where("not held_out"))
    out = language_cnn.identify(docs.select("doc_id", "held_out", "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query(
    "op3_line_dedup",
    f"""
    with lines as (
        select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
        from documents
    ), keyed as (
        select *, {ASCII_LOWER.format(f"trim(line, {SQL_SPACES})")} as key from lines
    ), common as (
        select key, max(doc_id) as keeper from keyed where length(key) >= 20
        group by key having count(distinct doc_id) >= 3
    ), marked as (
        select k.*, c.key is not null and k.doc_id <> c.keeper as dropped
        from keyed k left join common c on k.key = c.key
    )
    select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
    from marked group by doc_id
    """,
)
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that other documents repeat."""
    out = lines.dedup_lines(read(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", utf8_sha256("text").alias("kept_sha256"))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document by the byte-level BPE file."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    counts = token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query("op5_near_duplicates")
def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its group of near copies, on shingles of four words."""
    out = near_duplicates.near_duplicates(read(spark, folder, "documents"), shingle=4, percent=80)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query("op6_main_text")
def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The article of every page."""
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    out = main_text.extract(pages, main_text.learn(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document to token ids and back to bytes."""
    import public_tokenizers

    where = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = read(spark, folder, "documents").select("doc_id", "text")
    out = byte_bpe.encode(docs, "text", "ids", *where, decoded="raw")
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("raw"), 256).alias("decoded_sha256"),
    )


_CHAT_ESCAPE = "replace(replace(replace({0}, '\\', '\\b'), '#', '\\h'), '<', '\\l')"


@query(
    "op8_chat_format",
    f"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
        union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'
    ), ordered as (select *, row_number() over (partition by conv_id order by turn, role, text) as place from turns)
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
           sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by place) filter (where role = 'assistant'), '')) as loss_sha256,
           sum(13 + length(replace({_CHAT_ESCAPE.format("role")}, chr(10), '\\n'))
               + length({_CHAT_ESCAPE.format("text")}))::bigint as formatted_chars
    from ordered group by conv_id
    """,
)
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation as one text with a loss mask, and what reads back from it."""
    hard = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame(
        [(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string"
    )
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    events = rows.select("conv_id", F.col("turn").alias("seq"), "turn", F.lit(chat.MESSAGE).alias("kind"), "role", "text")
    out = chat.format_chats(events).withColumn("turns", chat.read_back(F.col("formatted")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("segments"))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        utf8_sha256(told).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        utf8_sha256(loss).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learned from labels of those that are not held out."""
    docs = read(spark, folder, "documents").select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    labels = read(spark, folder, "labels").where(~held_out(F.col("doc_id")))
    out = toxicity.score(docs, toxicity.learn(docs.where("not held_out"), labels))
    return out.select("doc_id", "held_out", "score", "predicted")


_WORDS = (
    "list_filter(regexp_split_to_array(" + ASCII_LOWER.format("text") + ", '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
)


@query(
    "op10_decontamination",
    f"""
    with texts as (
        select 'd' as kind, doc_id as id, {_WORDS} as words from documents where text is not null
        union all select 'i', item_id, {_WORDS} from benchmark where text is not null
    ), sizes as (select distinct least(len(words), 5) as k from texts where kind = 'i' and len(words) > 0), shingles as (
        select distinct kind, id, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) as shingle
        from texts, sizes where len(words) >= k and (kind = 'd' or k = least(len(words), 5))
    ), items as (select id, count(*) as n from shingles where kind = 'i' group by id)
    select d.id as doc_id, i.id as item_id, count(*) as n_common, any_value(n) as n_item
    from shingles d join shingles i on d.shingle = i.shingle join items on items.id = i.id
    where d.kind = 'd' and i.kind = 'i' group by d.id, i.id having 100 * count(*) >= 80 * any_value(n)
    """,
)
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a benchmark item, with the share of it in shingles."""
    return decontamination.contained_items(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query(
    "op11_mixing",
    r"""
    with sized as (
        select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
               ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 13))::bigint
                   / 4503599627370496::double as draw
        from documents
    ), summed as (select source, sum(size)::hugeint as source_size from sized group by source), weighed as (
        select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from summed
    ), before as (
        select *, sum(source_size) over () as total,
               coalesce(sum(source_size) over least_first, 0) as held,
               sum(weight) over () - coalesce(sum(weight) over least_first, 0) as free
        from weighed
        window least_first as (order by source_size * 10 // weight, source nulls last rows between unbounded preceding and 1 preceding)
    ), bounded as (select *, 200 * source_size * free < weight * (150 * total - 200 * held) as stops from before), shared as (
        select (select 150 * any_value(total) - 200 * coalesce(sum(source_size) filter (where stops), 0) from bounded) as words,
               (select sum(weight) filter (where not stops) from bounded) as parts
    ), targets as (
        select source, source_size, case when stops then (2 * source_size)::double
               else least((weight * words)::double / (100 * parts)::double, (2 * source_size)::double) end as target
        from bounded, shared
    ), rated as (select *, case when source_size > 0 then target / source_size::double else 0 end as rate from targets)
    select doc_id, size, source_size::bigint as source_size, target,
           size * (floor(rate)::bigint + (draw < rate - floor(rate))::bigint) as taken
    from sized join rated on sized.source is not distinct from rated.source
    """,
)
def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What a mixture of half as many words again takes of every document, with the size and target of its source."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "source")
    size = mixing.word_count(F.col("text"))
    taken = mixing.repetitions(docs).withColumn("size", size)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query(
    "op12_collocations",
    rf"""
    with pieces as (
        select coalesce(lang, 'und') as lang,
               unnest(string_split_regex({ASCII_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as piece
        from documents
    ), said as (
        select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces
    ), totals as (select lang, sum(len(w))::bigint as n from said group by lang), counted as materialized (
        select lang, g, len(g) as size, count(*)::hugeint as f from (
            select lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) as g
            from said, range(1, 5) as sizes(k) where len(w) >= k
        ) group by lang, g having count(*) >= 30
    ), halves as materialized (
        select lang, g, size, f as a, k, g[1:k] as first, g[k + 1:size] as rest from counted, range(1, 4) as places(k) where k < size
    ), cuts as (
        select h.lang, h.g, h.size, h.a, x.f as l, y.f as r, (2000000 * h.a) // (x.f + y.f) as score, h.k
        from halves h join counted x on x.lang = h.lang and x.g = h.first join counted y on y.lang = h.lang and y.g = h.rest
    ), best as (
        select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1
    ), covers as (
        select lang, g, max(f) as longest from (
            select lang, f, unnest(list_transform(range(1, size - k + 2), lambda i: g[i:i + k - 1])) as g
            from counted, range(2, 4) as sizes(k) where k < size
        ) group by lang, g
    ), kept as (
        select b.*, array_to_string(b.g, ' ') as phrase from best b left join covers c on b.lang = c.lang and b.g = c.g
        where c.longest is null or 100 * c.longest < 80 * b.a
    )
    select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
    from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept) join totals using (lang)
    where rank <= 2000
    """,
)
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 most cohesive phrases of every language."""
    return phrases.collocations(read(spark, folder, "documents"))


def _with_periods(docs: DataFrame) -> DataFrame:
    """docs, where every tenth text by the checksum of its id repeats a stretch of its own words up to its end."""
    code = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    given = docs.withColumn("_g", F.floor(code / 10)).withColumn("_words", F.when(code % 10 == 0, split))
    n = F.size("_words")
    a = (F.col("_g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("_g") % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("_words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.concat(F.slice("_words", F.lit(1), a), F.slice(tail, F.lit(1), n - a))
    return given.withColumn("text", F.when(n > 0, F.array_join(made, " ")).otherwise(F.col("text"))).drop("_g", "_words")


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of every document and its text without their repetitions."""
    docs = _with_periods(read(spark, folder, "documents").select("doc_id", "text"))
    out = runs.periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    out = out.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        utf8_sha256(F.array_join(told, "")).alias("runs_sha256"),
        utf8_sha256("collapsed").alias("collapsed_sha256"),
    )
