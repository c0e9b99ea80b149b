"""Near-duplicate documents by MinHash banding, signature check and exact confirmation.

1. One pass over the texts gives each document its shingle set's size, hash,
   band keys and signature. Texts with equal sets form a class at once, so a
   group of exact copies counts as one from here on.
2. Classes that share a band key are candidates. In each round every shared
   band is a star: one member is held against all others. Links that hold join
   components, and members of one component need no more comparison in a band, so
   a group of near copies shrinks after a round instead of making all pairs.
3. Candidates whose signatures agree are confirmed on their full shingle sets. A second
   pass over the texts has made these for the classes that share a band at all.
4. What is left in a band after the rounds are members of different components that were
   not yet compared. Where they are few, their pairs follow the same way. Bands that
   still hold many, as a group does whose members are alike but seldom enough so, are taken
   together into neighbourhoods. A neighbourhood is compared block against block inside the
   tasks, each block a bounded number of members with their sets; only links come out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.components import connected_components, joined, least_neighbours
from corpusflow.llm.words import BETWEEN_SPACES, groups, mix, shingle_hashes, shingles_of, word_hashes
from corpusflow.session import materialize
from corpusflow.workers import ship_by_value, trimmed

ship_by_value(__name__)

#: Bands and rows of a band: a pair of similarity 0.8 shares no band with probability 1.3e-7.
BANDS, ROWS = 40, 5
#: Signatures that agree in less than this share of places, a pair of similarity 0.8 has with
#: probability under 1e-9, are left out.
AGREEMENT = 0.6
#: Rounds of stars, members up to which the rest of a band makes its pairs, and members of a block of a neighbourhood.
ROUNDS, FEW, BLOCK = 2, 16, 512


def _families(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of universal hashes x -> a * x + b over 64 bits."""
    draws = np.random.default_rng(20240607).integers(0, 1 << 64, (2, count), np.uint64)
    return draws[0] | np.uint64(1), draws[1]


def minima(values: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 2048) -> np.ndarray:
    """The minimum of each universal hash over a set of 64-bit numbers."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), step):
        hashed = np.multiply.outer(a, values[i : i + step])
        hashed += b[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def _signature_rows(shingle: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _families(bands * rows)
        place = np.arange(bands, dtype=np.uint64)
        for batch in batches:
            for first_row, data, offsets in groups(batch.column(1)):
                words, _, _, first = word_hashes(data, offsets, BETWEEN_SPACES)
                runs = shingle_hashes(words, shingle)
                sizes, keys, band_keys, signatures = [], [], [], []
                for begin, end in zip(first[:-1], first[1:], strict=True):
                    found = np.unique(shingles_of(words, runs, begin, end, shingle))
                    sizes.append(len(found))
                    if not len(found):
                        keys.append(None), band_keys.append(None), signatures.append(None)
                        continue
                    keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    least = minima(found, a, b) >> np.uint64(32)
                    key = mix(place + np.uint64(1))
                    for r in range(rows):
                        key = mix(key ^ least[r::rows])
                    band_keys.append(key.view(np.int64))
                    signatures.append(least.astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first_row, len(sizes)),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(band_keys, pa.list_(pa.int64())),
                        pa.array(signatures, pa.binary()),
                    ],
                    ["doc", "n_shingles", "set_key", "bands", "signature"],
                )

    return run


def signatures(docs: DataFrame, doc: str, text: str, shingle: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc, n_shingles, set_key (hash of the set), bands (keys), signature; the last three null for empty sets."""
    schema = "doc long, n_shingles long, set_key binary, bands array<long>, signature binary"
    return docs.select(F.col(doc).cast("long"), F.col(text)).mapInArrow(trimmed(_signature_rows(shingle, bands, rows)), schema)


def _set_rows(shingle: int, wanted: np.ndarray):
    """Full shingle sets of the documents whose id may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(wanted, batch.column(0))))
            for first_row, data, offsets in groups(batch.column(1)):
                words, _, _, first = word_hashes(data, offsets, BETWEEN_SPACES)
                runs = shingle_hashes(words, shingle)
                sets = [
                    np.unique(shingles_of(words, runs, begin, end, shingle)).view(np.int64)
                    for begin, end in zip(first[:-1], first[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first_row, len(sets)), pa.array(sets, pa.list_(pa.int64()))], ["doc", "members"]
                )

    return run


#: Bits of a bitmap over ids or hashes, as a power of two: a fixed two megabytes, whatever the input.
BITMAP = 24


def bitmap_of(ids: DataFrame, bits: int = BITMAP) -> np.ndarray:
    """A bitmap of the low bits of one column of longs.

    It says no only to values that are not there, so it may filter ahead of an
    exact join. The driver gets at most 2 ** bits / 64 numbers.
    """
    slot = f"`{ids.columns[0]}` & {(1 << bits) - 1}L"
    words = (
        ids.select(F.expr(f"({slot}) >> 6 as at"), F.expr(f"shiftleft(1L, cast(({slot}) & 63 as int)) as bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["at"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(bitmap: np.ndarray, values: pa.Array) -> np.ndarray:
    """Which of the values may be in the bitmap; nulls are not."""
    there = values.is_valid().to_numpy(zero_copy_only=False)
    numbers = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return bitmap_hits(bitmap, numbers) & there


def bitmap_hits(bitmap: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    slot = numbers & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def _hopeful_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose signatures agree in enough places."""
    for batch in batches:
        x, y = (_signature_matrix(batch.column(c)) for c in (2, 3))
        agree = (x == y).mean(axis=1) >= AGREEMENT if len(x) else np.zeros(0, bool)
        yield batch.select([0, 1]).filter(pa.array(agree))


def _signature_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), -1) if len(column) else np.zeros((0, 1), "<u2")


def _confirmed(pairs: DataFrame, marks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough: first by signature, then on the full sets."""
    signed = pairs.join(marks.toDF("a", "left"), "a").join(marks.toDF("b", "right"), "b").select("a", "b", "left", "right")
    hopeful = signed.mapInArrow(trimmed(_hopeful_rows), "a long, b long")
    met = hopeful.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    common, total = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    sized = met.select("a", "b", common.alias("common"), total.alias("total"))
    return sized.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select("a", "b")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Values that two sorted sets share."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _block_links(percent: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Links between two blocks: pairs of different components, the first that holds for each two of these."""
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            x, y = (_signature_matrix(t["signature"]) for t in (left, right))
            # Sets are sorted as unsigned numbers.
            own_sets, sets = (
                [m.values.to_numpy(zero_copy_only=False).view(np.uint64) for m in t["members"]] for t in (left, right)
            )
            sizes, components = np.array([len(m) for m in sets]), right["component"].to_numpy()
            others_nodes = right["node"].to_numpy()
            joined: set[tuple[int, int]] = set()
            for i, (node, component, own) in enumerate(zip(left["node"].to_pylist(), left["component"].to_pylist(), own_sets, strict=True)):
                size = len(own)
                others = np.flatnonzero((components != component) & (100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size)))
                for j in others[(y[others] == x[i]).mean(axis=1) >= AGREEMENT]:
                    if (component, components[j]) not in joined:
                        common = _common(own, sets[j])
                        if 100 * common >= percent * (size + sizes[j] - common):
                            joined |= {(component, components[j]), (components[j], component)}
                            found.append((node, int(others_nodes[j])))
        columns = zip(*found, strict=True) if found else ([], [])
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return run


def _neighbourhood_links(hoods: DataFrame, marks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of different components within each neighbourhood, found block against block."""
    sized = hoods.groupBy("hood").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = hoods.join(sized, "hood").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.join(marks.toDF("node", "signature"), "node").join(sets.toDF("node", "members"), "node")
    columns = ["hood", "node", "component", "signature", "members"]
    left = placed.select(*columns, "block", F.explode(F.sequence("block", F.col("blocks") - 1))).toDF(*columns, "i", "j")
    right = placed.select(*columns, F.explode(F.sequence(F.lit(0), "block")), "block").toDF(*columns, "i", "j")
    met = left.groupBy("hood", "i", "j").cogroup(right.groupBy("hood", "i", "j"))
    return met.applyInArrow(_block_links(percent), "a long, b long")


def _remaining_links(open_members: DataFrame, marks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of all pairs of different components that share a band."""
    sized = open_members.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least"))
    many = open_members.join(sized.where(F.col("n") > FEW).select("key", "least"), "key")
    labels = connected_components(many.select("node", "least")).toDF("node", "hood")
    nodes = many.select("node", "component").distinct()
    hoods = materialize(nodes.join(labels, "node"), "neighbourhoods")

    few = open_members.join(sized.where(F.col("n") <= FEW).select("key"), "key", "left_semi")
    few = few.join(hoods.select("node", "hood"), "node", "left").select("key", "node", "component", "hood")
    pairs = few.toDF("key", "a", "x", "p").join(few.toDF("key", "b", "y", "q"), "key")
    together = F.coalesce(F.col("p") == F.col("q"), F.lit(False))
    pairs = pairs.where((F.col("a") < F.col("b")) & (F.col("x") != F.col("y")) & ~together).select("a", "b").distinct()
    return _confirmed(pairs, marks, sets, percent).union(_neighbourhood_links(hoods, marks, sets, percent))


def _still_open(members: DataFrame, middles: DataFrame, labels: DataFrame) -> DataFrame:
    """members but the middles, with the component of their node, for the bands that hold more than one."""
    labelled = members.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rest = labelled.join(middles.select("key", "a"), "key").where("node <> a").select("key", "node", "component")
    mixed = rest.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return rest.join(mixed.select("key"), "key", "left_semi")


def near_duplicates(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of docs: doc, n_shingles, component_id (the smallest id reachable over links).

    Words are runs without white space, A-Z lower-cased; a document's set holds its
    distinct runs of so many words, or all its words as one where it has
    fewer. Two documents are linked when 100 * common >= percent * union.

    Null and blank texts have empty sets and are linked with nothing. Rows with a
    null id take no part and have a null component. Rows that share an id are one
    node with the links of all of them. Equal texts always meet; different texts
    of the least similarity meet with probability 1 - 1.3e-7. Other columns are
    left out. No rows give no rows.
    """
    source = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"))
    signed = materialize(signatures(source, "doc", "text", shingle), "signatures")
    known = signed.where("doc is not null and set_key is not null")
    classes = materialize(known.groupBy("set_key").agg(F.min("doc").alias("rep")), "classes")

    heads = known.join(classes.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi")
    bands = heads.select(F.explode("bands").alias("key"), F.col("doc").alias("node"))
    shared = bands.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    members = materialize(bands.join(shared, "key", "left_semi").distinct(), "members")
    nodes = materialize(members.select("node").distinct(), "nodes")
    marks = materialize(heads.select("doc", "signature").join(nodes, F.col("doc") == F.col("node"), "left_semi"), "marks")
    sets = source.mapInArrow(trimmed(_set_rows(shingle, bitmap_of(nodes))), "doc long, members array<long>")
    sets = materialize(sets.join(nodes, F.col("doc") == F.col("node"), "left_semi"), "sets")

    # What is linked so far is kept as edges that come nearer to stars with each round. Members of one component may still
    # have different labels then: they are compared once more, and no link is lost. The last call joins them all.
    open_members, linked = members.withColumn("component", F.col("node")), docs.sparkSession.createDataFrame([], "a long, b long")
    for turn in range(ROUNDS + 1):
        if open_members.isEmpty():
            break
        if turn < ROUNDS:
            # The star's middle: the smallest id at first, later any that the turn's hash puts first.
            if turn == 0:
                middles = open_members.groupBy("key").agg(F.min("node").alias("a")).withColumn("of", F.col("a"))
            else:
                first = F.min(F.struct(F.xxhash64("node", F.lit(turn)), F.col("node").alias("a"), F.col("component").alias("of")))
                middles = open_members.groupBy("key").agg(first.alias("first")).select("key", "first.a", "first.of")
            met = open_members.join(middles, "key").where("component <> of")
            pairs = met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
            linked = joined(linked.union(_confirmed(pairs, marks, sets, percent)))
        else:
            linked = linked.union(_remaining_links(open_members, marks, sets, percent))
            break
        open_members = materialize(_still_open(open_members, middles, least_neighbours(linked)), "open")

    several = known.groupBy("doc").agg(F.count("*").alias("rows")).where("rows > 1").select("doc")
    own = known.join(several, "doc", "left_semi").join(classes, "set_key").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    labels = connected_components(linked.union(own)).toDF("rep", "component")
    roots = classes.join(labels, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("root"))
    return (
        signed.select("doc", "n_shingles", "set_key")
        .join(roots, "set_key", "left")
        .select("doc", "n_shingles", F.coalesce("root", "doc").alias("component_id"))
        .withColumn("component_id", F.when(F.col("doc").isNotNull(), F.col("component_id")))
        .withColumnRenamed("doc", doc)
    )
