"""Token chunks of documents.

One narrow projection and one explode: no shuffle, no Python. The cut happens
inside the row, on runs of tokens or where chunks overlap on the token array, and only finished chunk bodies leave it, so
the work is linear in the text however many chunks a document gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.ids import stable_id
from corpusflow.functions.text import byte_size
from corpusflow.functions.tokens import resolve_tokenizer, token_marks, token_runs, tokens
from corpusflow.operators.barrier import bound, computed_once
from corpusflow.options import ChunkOptions


def chunk_total(token_total: Column, max_tokens: int, overlap: int = 0) -> Column:
    """Number of chunks: the last one is the first that reaches the end."""
    step = max_tokens - overlap
    further = F.ceil((token_total - max_tokens) / F.lit(step)).cast("int")
    return F.when(token_total <= max_tokens, F.lit(1)).otherwise(further + 1)


#: Chunks of so many tokens at most are counted in runs of so many.
_LONG, _RUN = 1024, 128


def _count(body: Column) -> Column:
    """Tokens of a text that is not empty; only its last run is looked into."""
    return bound(token_runs(body, _RUN), lambda runs: (F.size(runs) - 1) * _RUN + token_marks(F.element_at(runs, -1)))


def token_chunks(
    df: DataFrame,
    key: str,
    text: str,
    options: ChunkOptions | None = None,
    keep: list[str] | None = None,
    tokenize: Callable[[Column], Column] = tokens,
) -> DataFrame:
    """Chunk rows of every non-empty text, linked to their neighbours.

    ``tokenize`` gives the text as an array of pieces that join to it again; another
    tokenizer comes in there, as column expressions or as a pandas UDF.
    Output: ``keep`` columns, document_id, pos, id, parent/left/right ids, body,
    byte_size, tokenizer, token_count.
    """
    opts = options or ChunkOptions()
    size, step = opts.max_tokens, opts.max_tokens - opts.overlap
    there = df.where(F.col(text).isNotNull() & (F.col(text) != ""))
    kept = [*(keep or []), F.col(key).alias("document_id")]
    if tokenize is tokens and not opts.overlap:
        cut = there.select(*kept, token_runs(F.col(text), size).alias("_runs"))

        def run(body: Column, pos: Column) -> Column:
            last = pos + 1 == F.size("_runs")
            count = F.when(last, _count(body) if size >= _LONG else token_marks(body)).otherwise(size)
            return F.struct(pos.alias("pos"), last.alias("last"), body.alias("body"), count.alias("token_count"))

        pieces = F.transform("_runs", run)
    else:
        cut = there.select(*kept, tokenize(F.col(text)).alias("_tokens")).withColumn("_total", chunk_total(F.size("_tokens"), size, opts.overlap))

        def one_chunk(pos: Column) -> Column:
            part = F.slice(F.col("_tokens"), pos * step + 1, F.lit(size))
            count = F.least(F.lit(size), F.size("_tokens") - pos * step)
            return F.struct(
                pos.alias("pos"),
                (pos + 1 == F.col("_total")).alias("last"),
                F.array_join(part, "").alias("body"),
                count.alias("token_count"),
            )

        pieces = F.transform(F.sequence(F.lit(0), F.col("_total") - 1), one_chunk)
    rows = cut.select(*(keep or []), "document_id", F.inline(pieces))
    document, pos = F.col("document_id"), F.col("pos")
    return rows.select(
        *(keep or []),
        "document_id",
        "pos",
        stable_id(document, pos).alias("id"),
        F.lit(None).cast("string").alias("parent_chunk_id"),
        F.when(pos > 0, stable_id(document, pos - 1)).alias("left_chunk_id"),
        F.when(~F.col("last"), stable_id(document, pos + 1)).alias("right_chunk_id"),
        "body",
        byte_size(F.col("body")).alias("byte_size"),
        F.lit(resolve_tokenizer(opts.tokenizer)).alias("tokenizer"),
        "token_count",
    )


#: Pieces that packing takes at a time. A fold copies what it has gathered at every step, which this bounds.
_TAKEN = 1024


def _packed(counts: Column, size: int) -> Column:
    """Places at which packing starts a chunk, given the token counts of consecutive pieces (one at least).

    As many pieces go together as fit; a piece beyond the size stands alone. Places are gathered as text,
    which a step copies as one block of memory.
    """
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(counts) - 1) / F.lit(_TAKEN)).cast("int")),
        lambda b: F.slice(counts, b * _TAKEN + 1, F.lit(_TAKEN)),
    )

    def state(held: Column, at: Column, places: Column) -> Column:
        return F.struct(held.alias("held"), at.alias("at"), places.alias("places"))

    def piece(acc: Column, count: Column) -> Column:
        opens = acc["held"] + count > size
        places = F.when(opens, F.concat(acc["places"], acc["at"].cast("string"), F.lit(","))).otherwise(acc["places"])
        return state(F.when(opens, count).otherwise(acc["held"] + count), acc["at"] + 1, places)

    def block(acc: Column, own: Column) -> Column:
        done = F.aggregate(own, state(acc["held"], acc["at"], F.lit("")), piece)
        return bound(done, lambda d: state(d["held"], d["at"], F.concat(acc["places"], d["places"])))

    # Before the first piece a chunk counts as full.
    packed = F.aggregate(blocks, state(F.lit(size), F.lit(0), F.lit("")), block, lambda acc: acc["places"])
    return F.split(F.rtrim(packed, F.lit(",")), ",").cast("array<int>")


#: Where a text may be parted, coarse to fine: behind an empty line, behind a sentence.
HEADING = r"(?m)(?=^#{1,6} )"
PARAGRAPH, SENTENCE = r"(?<=\n\n)(?!\n)", r"(?<=[.!?][ \n])(?=\S)"


def _parts(text: Column, pattern: str) -> Column:
    return F.filter(F.split(text, pattern, -1), lambda part: part != "")


def _parsed(text: Column, tokenize: Callable[[Column], Column]) -> Column:
    return F.struct(text.alias("text"), tokenize(text).alias("tokens"))


def _token_pieces(parsed: Column, size: int) -> Column:
    """An array of tokenized parts as pieces of at most so many tokens, with the token count of each."""

    def of_part(part: Column) -> Column:
        # The part is computed already: a piece costs no more than its own tokens.
        total = F.size(part["tokens"])
        places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((total - 1) / F.lit(size)).cast("int")))

        def piece(at: Column) -> Column:
            own = F.slice(part["tokens"], at * size + 1, F.lit(size))
            return F.struct(F.array_join(own, "").alias("body"), F.least(F.lit(size), total - at * size).alias("token_count"))

        return F.transform(places, piece)

    return F.flatten(F.transform(parsed, of_part))


def section_chunks(
    df: DataFrame,
    key: str,
    text: str,
    options: ChunkOptions,
    keep: list[str] | None = None,
    tokenize: Callable[[Column], Column] = tokens,
) -> DataFrame:
    """Chunks that follow the text's own structure; joined they are the text again.

    ``heading``: a chunk for each Markdown heading with what follows it, cut by tokens where
    it is too long. ``recursive``: paragraphs, of those too long the sentences, of those
    too long the tokens, packed in order into chunks of at most max_tokens. Texts are tokenized
    piece by piece, each piece once, and only finished chunks leave the row, so the work is linear in
    the text. Same columns as token_chunks; chunks do not overlap.
    """
    size, kept = options.max_tokens, [*(keep or []), "document_id"]
    rows = df.where(F.col(text).isNotNull() & (F.col(text) != "")).select(
        *(keep or []), F.col(key).alias("document_id"), F.col(text).alias("_text")
    )

    def parsed(parts: Column) -> Column:
        return F.transform(parts, lambda part: _parsed(part, tokenize))

    # One expression from text to chunks: between steps arrays stay objects, of which a slice costs its own length only.
    whole = F.col("_text")
    if options.strategy == "heading":
        chunks = _token_pieces(parsed(_parts(whole, HEADING)), size)
    else:
        sentences = F.transform(
            parsed(_parts(whole, PARAGRAPH)),
            lambda p: F.when(F.size(p["tokens"]) <= size, F.array(p)).otherwise(parsed(_parts(p["text"], SENTENCE))),
        )

        def joined(pieces: Column) -> Column:
            def chunk(starts: Column, start: Column, i: Column) -> Column:
                end = F.coalesce(F.try_element_at(starts, i + 2), F.size(pieces))
                own = F.slice(pieces, start + 1, end - start)
                total = F.aggregate(own["token_count"], F.lit(0), lambda acc, count: acc + count)
                return F.struct(F.array_join(own["body"], "").alias("body"), total.alias("token_count"))

            return bound(_packed(pieces["token_count"], size), lambda starts: F.transform(starts, lambda s, i: chunk(starts, s, i)))

        chunks = bound(_token_pieces(F.flatten(sentences), size), joined)
    rows = computed_once(rows, {"_chunks": chunks})
    made = rows.select(*kept, F.size("_chunks").alias("_total"), F.posexplode("_chunks").alias("pos", "_chunk"))
    document, pos, body = F.col("document_id"), F.col("pos"), F.col("_chunk.body")
    return made.select(
        *kept,
        "pos",
        stable_id(document, pos).alias("id"),
        F.lit(None).cast("string").alias("parent_chunk_id"),
        F.when(pos > 0, stable_id(document, pos - 1)).alias("left_chunk_id"),
        F.when(pos + 1 < F.col("_total"), stable_id(document, pos + 1)).alias("right_chunk_id"),
        body.alias("body"),
        byte_size(body).alias("byte_size"),
        F.lit(resolve_tokenizer(options.tokenizer)).alias("tokenizer"),
        F.col("_chunk.token_count").alias("token_count"),
    )


def cut(df: DataFrame, key: str, text: str, options: ChunkOptions, keep: list[str] | None = None) -> DataFrame:
    """Chunks by the strategy of the options."""
    make = token_chunks if options.strategy == "token" else section_chunks
    return make(df, key, text, options, keep)


def empty_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows chunking leaves out, with the reason."""
    return df.where(F.col(text).isNull() | (F.col(text) == "")).select(
        F.col(key).alias("document_id"), F.lit("ErrContentEmpty").alias("error")
    )


def broken_links(chunks: DataFrame) -> DataFrame:
    """Chunks whose left or right neighbour is missing or does not point back.

    A pair of neighbours is named twice: by the left one as its right, by the right
    one as its left. Pairs named once are broken.
    """
    rightward = chunks.where(F.col("right_chunk_id").isNotNull()).select(
        F.col("id").alias("a"), F.col("right_chunk_id").alias("b"), F.lit(True).alias("by_left")
    )
    leftward = chunks.where(F.col("left_chunk_id").isNotNull()).select(
        F.col("left_chunk_id").alias("a"), F.col("id").alias("b"), F.lit(True).alias("by_right")
    )
    pairs = rightward.join(leftward, ["a", "b"], "full_outer")
    return pairs.where(F.col("by_left").isNull() | F.col("by_right").isNull()).select(
        F.when(F.col("by_left"), F.col("a")).otherwise(F.col("b")).alias("id"),
        F.when(F.col("by_left"), "right").otherwise("left").alias("side"),
    )
