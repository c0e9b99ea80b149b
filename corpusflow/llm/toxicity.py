"""Toxicity by a convolutional text classifier over hashed words.

A word and its first bytes are hashed into buckets; the sum of their embeddings stands
for the word, so that unseen words of a known family have a meaning too. Filters of
several widths run over the words, the strongest answer of each filter in the whole
text is kept, and a logistic layer makes a score of these. Every labelled text takes
part: three quarters train the model, in rounds in which each part of the rows makes its own steps
in its task and the parts' models are averaged; the others calibrate it. The texts are scored in the
tasks, in groups of bounded size.

The threshold is calibrated by language, which is guessed from the function words of
the text, and moved to a score of 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.near_duplicates import bitmap_of, in_bitmap
from corpusflow.llm.training import Adam
from corpusflow.llm.words import ALPHANUMERIC, fold_case, groups, hash_spans, word_hashes
from corpusflow.session import materialize
from corpusflow.workers import ship_by_value, trimmed

ship_by_value(__name__)

BUCKETS, DIMENSIONS, WIDTHS, FILTERS = 1 << 16, 8, (1, 2, 3), 8
#: Bytes of the beginnings that a word is known by besides itself.
BEGINNINGS = (4, 6)
#: Rows that train a model of their own in a round, before these are averaged; words of a long text that a step works on at a time.
ROWS_PER_PART, STRETCH = 8192, 4096
EPOCHS, BATCH, RATE = 6, 64, 0.01
#: One row of so many calibrates; rows of each label that a language must have among them to get a threshold of its own.
CALIBRATES, LEAST_ROWS = 4, 20
#: Buckets whose sums travel in a row; steps of a logit that calibration tells apart, and the greatest logit.
BLOCK, STEPS, GREATEST = 1024, 256, 32
#: Bits of the bitmap of labelled ids at most: 32 megabytes.
MOST_BITS = 28

#: Frequent function words; a text's language group is the one it has most of, the last group is for none.
FUNCTION_WORDS = (
    ("the", "of", "and", "to", "is", "that", "it", "for", "was", "with"),
    ("le", "les", "et", "des", "du", "une", "est", "que", "pour", "dans"),
    ("der", "die", "und", "den", "von", "zu", "das", "mit", "nicht", "ist"),
    ("el", "los", "y", "en", "que", "del", "las", "un", "por", "con"),
)
LANGUAGES = len(FUNCTION_WORDS) + 1
_PAD = max(WIDTHS) - 1


def _word_hash(words: tuple[str, ...]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return hash_spans(data, np.concatenate([[0], ends[:-1]]), ends)


def buckets(hashes: np.ndarray) -> np.ndarray:
    """Bucket 0 is left for places without a word."""
    return np.maximum((hashes >> np.uint64(48)).astype(np.uint16), 1)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts: buckets of each word and its beginnings, first word of each text, language group of each text."""
    hashes, start, end, first = word_hashes(data, offsets, ALPHANUMERIC)
    folded = fold_case(data)
    beginnings = [hash_spans(folded, start, np.minimum(end, start + n)) for n in BEGINNINGS]
    return np.column_stack([buckets(h) for h in (hashes, *beginnings)]), first, language_groups(hashes, first)


def language_groups(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The language group of each text from the hashes of its words."""
    counts = np.zeros((len(first) - 1, LANGUAGES))
    for i, words in enumerate(FUNCTION_WORDS):
        found = np.isin(hashes, _word_hash(words))
        counts[:, i] = np.diff(np.concatenate([[0], np.cumsum(found)])[first])
    counts[:, -1] = 0.5
    return counts.argmax(axis=1)


def _padded(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with empty places behind each text; where windows of each text begin and end."""
    length = np.diff(first)
    start = first[:-1] + _PAD * np.arange(len(length))
    out = np.zeros((len(ids) + _PAD * len(length) + _PAD, ids.shape[1]), np.int64)
    out[np.arange(len(ids)) + _PAD * np.repeat(np.arange(len(length)), length)] = ids
    return out, start, start + np.maximum(length, 1)


@dataclass
class Model:
    params: dict[str, np.ndarray]
    thresholds: np.ndarray

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        words, start, end = _padded(ids, first)
        n = len(words) - _PAD
        embedding = self.params["embedding"]
        rows = embedding[words[:, 0]]
        for i in range(1, words.shape[1]):
            rows += embedding[words[:, i]]
        cuts = np.column_stack([start, end]).ravel()
        pooled = []
        for w in WIDTHS:
            kernel = self.params[f"w{w}"].reshape(w, DIMENSIONS, FILTERS)
            answer = rows[:n] @ kernel[0]
            for j in range(1, w):
                answer += rows[j : n + j] @ kernel[j]
            # One more row, so that the last text's end is a place to cut at.
            pooled.append(np.maximum.reduceat(np.concatenate([answer, answer[-1:]]), cuts, axis=0)[::2])
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.params["bias"], 0)
        return hidden @ self.params["out"] + self.params["out_bias"][0]

    def scores(self, ids: np.ndarray, first: np.ndarray, language: np.ndarray) -> np.ndarray:
        logit = self.logits(ids, first) - self.thresholds[language]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _initial(ids: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Small random numbers; one dimension of the embedding starts as the log odds of the bucket's texts."""
    return _started(_texts_of(ids, labels), np.bincount(labels, minlength=2), rng)


def _texts_of(ids: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """How many texts of each label have each bucket."""
    counts = np.zeros((2, BUCKETS))
    for words, label in zip(ids, labels, strict=True):
        counts[label, np.unique(words)] += 1
    return counts


def _started(counts: np.ndarray, totals: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    odds = np.log((counts[1] + 1) / (totals[1] + 2)) - np.log((counts[0] + 1) / (totals[0] + 2))
    odds[counts.sum(axis=0) == 0] = 0
    odds[0] = 0
    embedding = rng.normal(0, 0.05, (BUCKETS, DIMENSIONS))
    embedding[0] = 0
    embedding[:, 0] = odds / 6
    params = {"embedding": embedding, "bias": np.zeros(len(WIDTHS) * FILTERS)}
    for w in WIDTHS:
        kernel = rng.normal(0, 0.2, (w, DIMENSIONS, FILTERS))
        kernel[:, 0, :] = rng.uniform(0.2, 1, (w, FILTERS))
        params[f"w{w}"] = kernel.reshape(w * DIMENSIONS, FILTERS)
    params["out"] = rng.uniform(0, 0.3, len(WIDTHS) * FILTERS)
    params["out_bias"] = np.full(1, -1.0)
    return params


def _strongest(params: dict[str, np.ndarray], words: np.ndarray) -> np.ndarray:
    """A long text as the windows that its filters answer to most, each followed by empty places.

    Only these have a part in the pooled answers and their gradients, so a step on them is a step on the whole text.
    """
    if len(words) <= STRETCH:
        return words
    best = {w: (np.full(FILTERS, -np.inf), np.zeros(FILTERS, np.int64)) for w in WIDTHS}
    for begin in range(0, len(words), STRETCH):
        rows = params["embedding"][words[begin : begin + STRETCH + _PAD]].sum(axis=1)
        rows = np.concatenate([rows, np.zeros((_PAD, DIMENSIONS))])
        n = min(STRETCH, len(words) - begin)
        for w in WIDTHS:
            answer = np.concatenate([rows[j : n + j] for j in range(w)], axis=1) @ params[f"w{w}"]
            at, value = answer.argmax(axis=0), answer.max(axis=0)
            more = value > best[w][0]
            best[w] = np.where(more, value, best[w][0]), np.where(more, at + begin, best[w][1])
    none = np.zeros((_PAD, words.shape[1]), words.dtype)
    places = [(at, w) for w in WIDTHS for at in best[w][1]]
    return np.concatenate([part for at, w in places for part in (words[at : at + w], none)])


def _step(params: dict[str, np.ndarray], ids: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted log loss of a few texts; only the strongest window of a filter has a part in them."""
    first = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    words, start, end = _padded(np.concatenate(ids), first)
    used, inverse = np.unique(words, return_inverse=True)
    inverse = inverse.reshape(words.shape)
    rows = params["embedding"][used][inverse].sum(axis=1)
    n = len(words) - _PAD
    pooled, best = [], []
    for w in WIDTHS:
        answer = np.concatenate([rows[j : n + j] for j in range(w)], axis=1) @ params[f"w{w}"]
        at = np.array([s + answer[s:e].argmax(axis=0) for s, e in zip(start, end, strict=True)])
        best.append(at)
        pooled.append(np.take_along_axis(answer, at, axis=0))
    raw = np.concatenate(pooled, axis=1) + params["bias"]
    hidden = np.maximum(raw, 0)
    p = 1 / (1 + np.exp(-np.clip(hidden @ params["out"] + params["out_bias"][0], -30, 30)))
    delta = (p - labels) * weights / len(labels)
    back = np.outer(delta, params["out"]) * (raw > 0)
    grads = {"out": hidden.T @ delta, "out_bias": np.array([delta.sum()]), "bias": back.sum(axis=0)}
    to_embedding = np.zeros((len(used), DIMENSIONS))
    for i, w in enumerate(WIDTHS):
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        kernel = params[f"w{w}"].reshape(w, DIMENSIONS, FILTERS)
        to_kernel = np.zeros_like(kernel)
        for j in range(w):
            at = best[i] + j
            to_kernel[j] = np.einsum("bfd,bf->df", rows[at], g)
            share = (g[:, :, None] * kernel[j].T[None]).reshape(-1, DIMENSIONS)
            for i_word in inverse[at].reshape(-1, words.shape[1]).T:
                np.add.at(to_embedding, i_word, share)
        grads[f"w{w}"] = to_kernel.reshape(w * DIMENSIONS, FILTERS)
    return grads | {"used": used, "rows": to_embedding}


def _threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with the fewest weighted errors. Equal logits stay together."""
    order = np.argsort(logits)
    x, toxic, w = logits[order], labels[order] == 1, weights[order]
    errors = np.concatenate([[0], np.cumsum(np.where(toxic, w, 0))]) + np.concatenate([[0], np.cumsum(np.where(toxic, 0, w)[::-1])])[::-1]
    edges = np.concatenate([[x[0] - 2], x, [x[-1] + 2]])
    errors = np.where(np.diff(edges) > 0, errors, np.inf)
    gaps = np.where(errors <= errors.min() + 1e-9, np.diff(edges), -1)
    i = int(gaps.argmax())
    return float((edges[i] + edges[i + 1]) / 2)


@dataclass
class Training:
    """A model while it is trained: its numbers and the moments of the steps so far."""

    params: dict[str, np.ndarray]
    #: Sums of squared gradients of the embedding's rows, which are seen seldom (Adagrad).
    speed: np.ndarray
    first: dict[str, np.ndarray]
    second: dict[str, np.ndarray]
    steps: int = 0

    @staticmethod
    def of(params: dict[str, np.ndarray]) -> Training:
        adam = Adam({k: v for k, v in params.items() if k != "embedding"}, RATE)
        return Training(params, np.zeros(BUCKETS), adam.first, adam.second)

    def copy(self) -> Training:
        whole = [{k: v.copy() for k, v in part.items()} for part in (self.params, self.first, self.second)]
        return Training(whole[0], self.speed.copy(), whole[1], whole[2], self.steps)

    def learn(self, ids: list[np.ndarray], labels: np.ndarray, balance: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over some texts."""
        adam = Adam({k: v for k, v in self.params.items() if k != "embedding"}, RATE)
        adam.first, adam.second, adam.step = self.first, self.second, self.steps
        order = rng.permutation(len(ids))
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            grads = _step(self.params, [_strongest(self.params, ids[k]) for k in some], labels[some], balance[labels[some]])
            used, rows = grads.pop("used"), grads.pop("rows")
            rows[used == 0] = 0
            self.speed[used] += (rows**2).mean(axis=1)
            self.params["embedding"][used] -= 0.05 * rows / (np.sqrt(self.speed[used]) + 1e-6)[:, None]
            adam.update(grads)
        self.steps = adam.step

    def small(self) -> np.ndarray:
        """Everything but the embedding, as one array."""
        parts = [part[k].ravel() for part in (self.params, self.first, self.second) for k in sorted(self.first)]
        return np.concatenate([*parts, [float(self.steps)]])

    def set_small(self, values: np.ndarray) -> None:
        at = 0
        for part in (self.params, self.first, self.second):
            for k in sorted(self.first):
                part[k] = values[at : at + part[k].size].reshape(part[k].shape).copy()
                at += part[k].size
        self.steps = round(values[-1])


_SUMS = "block int, part int, sums binary"


def _sum_rows(part: int, blocks: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for block, values in blocks:
        if values.any():
            columns = [pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([values.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "part", "sums"])


def _added(table: pa.Table) -> pa.Table:
    """The sum of a block's rows, in the order of their parts: reruns give the same bits."""
    table = table.sort_by([("part", "ascending"), ("sums", "ascending")])
    total = np.zeros(len(table["sums"][0].as_py()) // 8)
    for value in table["sums"]:
        total += np.frombuffer(value.as_buffer())
    return pa.table({"block": table["block"][:1], "part": pa.array([0], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


def _collected(sums: DataFrame) -> dict[int, np.ndarray]:
    """Block number to sums: of bounded size, however many rows and tasks there are."""
    return {r["block"]: np.frombuffer(r["sums"]) for r in sums.groupBy("block").applyInArrow(_added, _SUMS).collect()}


def _words_of(column: pa.Array) -> list[np.ndarray]:
    """Buckets of each text's words; a text without words is one empty place."""
    width = 1 + len(BEGINNINGS)
    found = [np.frombuffer(w.as_buffer(), np.uint16).reshape(-1, width) for w in column]
    return [x if len(x) else np.zeros((1, width), np.uint16) for x in found]


def _counted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS))
    for batch in batches:
        counts += _texts_of(_words_of(batch.column(2)), batch.column(1).to_numpy())
    yield from _sum_rows(0, ((i, counts[:, i * BLOCK : (i + 1) * BLOCK].ravel()) for i in range(BUCKETS // BLOCK)))


def _texts_by_bucket(rows: DataFrame) -> np.ndarray:
    counts = np.zeros((2, BUCKETS))
    for block, found in _collected(rows.mapInArrow(trimmed(_counted_rows), _SUMS)).items():
        counts[:, block * BLOCK : (block + 1) * BLOCK] = found.reshape(2, BLOCK)
    return counts


def _round_of(state, balance: np.ndarray, seed: int):
    """A pass over each part's rows from the same start: what it changed, by block, and its small numbers under -1.

    A part of 0 rows says nothing. Rows of a part lie together, in an order that does not change.
    """

    def changes(part: int, own: Training, start: Training, rows: int) -> Iterator[pa.RecordBatch]:
        moved = own.params["embedding"] - start.params["embedding"]
        speed = own.speed - start.speed
        whole = np.column_stack([moved, speed, speed > 0])
        yield from _sum_rows(part, [(-1, np.append(own.small() * rows, rows))])
        yield from _sum_rows(part, ((i, whole[i * BLOCK : (i + 1) * BLOCK].ravel()) for i in range(BUCKETS // BLOCK)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = Training(**state.value)
        own, part, rows = None, -1, 0
        for batch in batches:
            parts, labels, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _words_of(batch.column(2))
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                if begin == end:
                    continue
                if parts[begin] != part:
                    if own is not None:
                        yield from changes(part, own, start, rows)
                    own, part, rows = start.copy(), int(parts[begin]), 0
                own.learn(ids[begin:end], labels[begin:end], balance, np.random.default_rng([seed, part, rows]))
                rows += end - begin
        if own is not None:
            yield from changes(part, own, start, rows)

    return run


def _averaged(start: Training, sums: dict[int, np.ndarray]) -> Training:
    """The parts' models as one: a bucket's change is the mean of the parts that have it, the rest the mean of all rows."""
    out = start.copy()
    small = sums.pop(-1)
    out.set_small(small[:-1] / small[-1])
    for block, found in sums.items():
        found = found.reshape(BLOCK, DIMENSIONS + 2)
        share = found[:, :-1] / np.maximum(found[:, -1:], 1)
        at = slice(block * BLOCK, (block + 1) * BLOCK)
        out.params["embedding"][at] += share[:, :-1]
        out.speed[at] += share[:, -1]
    return out


def _logit_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**model.value)
        for batch in batches:
            ids = _words_of(batch.column(2))
            logits = np.zeros(len(ids))
            for i in range(0, len(ids), BATCH):
                some = ids[i : i + BATCH]
                logits[i : i + BATCH] = known.logits(np.concatenate(some), np.concatenate([[0], np.cumsum([len(x) for x in some])]))
            steps = np.round(np.clip(logits, -GREATEST, GREATEST) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(3), pa.array(steps)], ["label", "language", "step"])

    return run


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """Thresholds from all rows, which are counted by label, language and logit: a table of bounded size, however many they are."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(model))
    found = rows.mapInArrow(trimmed(_logit_rows(shared)), "label int, language int, step int").groupBy("label", "language", "step").count().toArrow()
    shared.destroy()
    labels, language, step, weights = (found[c].to_numpy() for c in ("label", "language", "step", "count"))
    logits = step / STEPS
    model.thresholds[:] = _threshold(logits, labels, weights)
    for g in range(LANGUAGES):
        own = language == g
        if min(np.bincount(labels[own], weights[own], minlength=2)) >= LEAST_ROWS:
            model.thresholds[g] = _threshold(logits[own], labels[own], weights[own])
    return model


def fit(rows: DataFrame) -> Model:
    """Train and calibrate on texts: part, label, words (buckets), language, calibrates.

    Without both labels every score is near 0, or 1 if only that label is there.
    """
    rng, spark = np.random.default_rng(9), rows.sparkSession
    counts = np.zeros((2, 2), np.int64)
    for r in rows.groupBy("calibrates", "label").count().collect():
        counts[int(r["calibrates"]), r["label"]] = r["count"]
    there = counts.sum(axis=0)
    if not there.all():
        params = _initial([], np.zeros(0, np.int64), rng)
        params["out"][:] = 0
        params["out_bias"][:] = 3.0 if there[1] else -3.0
        return Model(params, np.zeros(LANGUAGES))
    train, later, totals = rows.where("not calibrates"), rows.where("calibrates"), counts[0]
    if not counts.all():
        # So few that one side lacks a label: all rows take part in both.
        train, later, totals = rows, rows, there
    balance = totals.sum() / (2 * totals)
    state = Training.of(_started(_texts_by_bucket(train), totals, rng))
    for turn in range(EPOCHS if totals.sum() > 1000 else 3 * EPOCHS):
        shared = spark.sparkContext.broadcast(vars(state))
        state = _averaged(state, _collected(train.mapInArrow(trimmed(_round_of(shared, balance, turn)), _SUMS)))
        shared.destroy()
    return _calibrated(Model({k: v.astype(np.float32) for k, v in state.params.items()}, np.zeros(LANGUAGES)), later)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows to learn from the text's language group and buckets; the other columns stay."""
    for batch in batches:
        names = batch.schema.names[:-1]
        for row, data, offsets in groups(batch.column(len(names))):
            ids, first, language = features(data, offsets)
            out = [ids[begin:end].tobytes() for begin, end in zip(first[:-1], first[1:], strict=True)]
            kept = [c.slice(row, len(out)) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.binary()), pa.array(language.astype(np.int32))], [*names, "words", "language"])


def _in_bitmap(bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bitmap.value, batch.column(0))))

    return run


def learn(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from all labelled texts, whole. The hash of its id says whether a text trains or calibrates, and in which part.

    Labels other than 0 and 1, null ids and ids without a text are left out.
    """
    known = labels.select(F.col(doc).alias("_id"), F.col(label).cast("int").alias("_label")).where("_id is not null and _label in (0, 1)")
    count, number = known.count(), F.xxhash64(F.col("_id").cast("string"))
    parts = max(1, -(-count // ROWS_PER_PART))
    # Only texts that may have a label travel: a bitmap of the ids, of bounded size, leaves out the others before the exact join.
    hits = docs.sparkSession.sparkContext.broadcast(bitmap_of(known.select(number), min(MOST_BITS, max(16, (16 * count).bit_length()))))
    rows = docs.select(F.col(doc).alias("_id"), F.col(text).alias("_text")).withColumn("_hash", number).select("_hash", "_id", "_text")
    rows = rows.mapInArrow(trimmed(_in_bitmap(hits)), rows.schema).join(known.hint("merge"), "_id")
    part, calibrates = F.pmod("_hash", F.lit(parts)).cast("int"), F.pmod(F.xxhash64("_hash"), F.lit(CALIBRATES)) == 0
    # Parts lie whole and in one order in the files; a task that reads several trains them one after the other.
    rows = rows.select(part.alias("part"), F.col("_label").alias("label"), calibrates.alias("calibrates"), "_hash", "_text")
    dealt = rows.repartitionById(parts, "part").sortWithinPartitions("part", "_hash", "_text", "label").drop("_hash")
    found = dealt.mapInArrow(trimmed(_feature_rows), "part int, label int, calibrates boolean, words binary, language int")
    return fit(materialize(found.select("part", "label", "words", "language", "calibrates"), "toxicity_words"))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from 0.5 on). Null text counts as empty, which has a score too.

    Columns of docs called score or predicted, in any case, are replaced; rows are independent of each other.
    """
    # Plain arrays travel, so that executors need no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    names = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**shared.value)
        for batch in batches:
            for row, data, offsets in groups(batch.column(at), 1 << 20):
                ids, first, language = features(data, offsets)
                found = known.scores(ids, first, language).astype(np.float64)
                own = [c.slice(row, len(found)) for c in batch.columns]
                more = [pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(own + more, [*names, "score", "predicted"])

    kept = docs.select(*names)
    fields = [*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return kept.mapInArrow(trimmed(run), T.StructType(fields))
