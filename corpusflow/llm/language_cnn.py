"""Language identification by a convolutional network over bytes.

Texts are cut into windows of a fixed number of bytes. Filters of several widths run
over each window, the strongest answer of each is kept, and a softmax over
these gives the window's languages; a text has the mean of its windows. The network is
trained in numpy on windows of a bounded sample. In the tasks, windows of many
texts are batched; what a pair of neighbouring bytes adds to a filter is one table lookup.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.training import Adam, sampled
from corpusflow.llm.words import groups
from corpusflow.session import materialize
from corpusflow.workers import ship_by_value, trimmed

ship_by_value(__name__)

WINDOW, DIMENSIONS, WIDTHS, FILTERS = 128, 8, (2, 3, 4), 12
#: Learning takes so many rows of each language, and of all windows of these rows so many.
ROWS_PER_LANGUAGE, WINDOWS_PER_LANGUAGE = 800, 3200
EPOCHS, BATCH, RATE = 6, 128, 0.01
UNDETERMINED = "und"
#: Windows that are worked on together.
WINDOWS_AT_ONCE = 4096


def _byte_classes() -> np.ndarray:
    """Letters without case; digits, white space and other ASCII as one class each; every other byte by itself. 0 pads."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            out[b] = b - 0x80 + 30
        elif c.isalpha():
            out[b] = ord(c.lower()) - ord("a") + 1
        else:
            out[b] = 27 if c.isdigit() else 28 if b in (0x20, *range(9, 14)) else 29
    return out


_CLASS = _byte_classes()
_CLASSES = 160
_ASCII_LETTER = np.array([chr(b).isalpha() and b < 0x80 for b in range(256)])


@dataclass
class Model:
    names: list[str]
    params: dict[str, np.ndarray]

    def tables(self) -> list[list[np.ndarray]]:
        """For each width, what each pair of neighbouring classes adds (and the last class alone where the width is odd)."""
        out = []
        for w in WIDTHS:
            kernel = self.params[f"w{w}"].reshape(w, DIMENSIONS, FILTERS)
            one = [self.params["embedding"] @ kernel[j] for j in range(w)]
            parts = [(one[j][:, None, :] + one[j + 1][None, :, :]).reshape(-1, FILTERS) for j in range(0, w - 1, 2)]
            out.append([p.astype(np.float32) for p in (parts + [one[-1]] if w % 2 else parts)])
        return out

    def probabilities(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Languages of windows of byte classes."""
        pairs = windows[:, :-1].astype(np.int32) * _CLASSES + windows[:, 1:]
        pooled = []
        for w, parts in zip(WIDTHS, tables, strict=True):
            places = windows.shape[1] - w + 1
            answer = parts[0][pairs[:, :places]]
            for j, part in enumerate(parts[1:], 1):
                odd = 2 * j == w - 1
                answer += part[(windows if odd else pairs)[:, 2 * j : 2 * j + places]]
            pooled.append(answer.max(axis=1))
        logits = np.concatenate(pooled, axis=1) @ self.params["out"] + self.params["bias"]
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        return logits / logits.sum(axis=1, keepdims=True)


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of byte classes over all of each text, and the first window of each text; an empty text has one."""
    length = np.diff(offsets)
    count = np.maximum(1, -(-length // WINDOW))
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(int(first[-1]) * WINDOW, np.uint8)
    shift = first[:-1] * WINDOW - offsets[:-1]
    out[np.arange(len(data)) + np.repeat(shift, length)] = _CLASS[data]
    return out.reshape(-1, WINDOW), first


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have a letter of any script."""
    found = np.diff(np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])[offsets]) > 0
    for i in np.flatnonzero(~found):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(c.isalpha() for c in text)
    return found


def _step(params: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss of a batch of windows; only a filter's strongest place has a part in them."""
    b = np.arange(len(x))[:, None]
    pooled, best = [], []
    for w in WIDTHS:
        kernel = params[f"w{w}"].reshape(w, DIMENSIONS, FILTERS)
        places = x.shape[1] - w + 1
        answer = (params["embedding"] @ kernel[0])[x[:, :places]]
        for j in range(1, w):
            answer += (params["embedding"] @ kernel[j])[x[:, j : j + places]]
        at = answer.argmax(axis=1)
        best.append(at)
        pooled.append(np.take_along_axis(answer, at[:, None, :], axis=1)[:, 0])
    hidden = np.concatenate(pooled, axis=1)
    logits = hidden @ params["out"] + params["bias"]
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(x)), y] -= 1
    p /= len(x)
    back = p @ params["out"].T
    grads = {"out": hidden.T @ p, "bias": p.sum(axis=0), "embedding": np.zeros_like(params["embedding"])}
    for i, w in enumerate(WIDTHS):
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        kernel = params[f"w{w}"].reshape(w, DIMENSIONS, FILTERS)
        to_kernel = np.zeros_like(kernel)
        for j in range(w):
            there = x[b, best[i] + j]
            by_class = np.zeros((_CLASSES, FILTERS))
            np.add.at(by_class, (there, np.arange(FILTERS)[None, :]), g)
            to_kernel[j] = params["embedding"].T @ by_class
            grads["embedding"] += by_class @ kernel[j].T
        grads[f"w{w}"] = to_kernel.reshape(w * DIMENSIONS, FILTERS)
    return grads


def fit(windows: np.ndarray, names: list[str]) -> Model:
    """Train on windows of byte classes with their languages."""
    rng = np.random.default_rng(5)
    known = sorted(set(names))
    y = np.array([known.index(n) for n in names], np.int64)
    count = len(WIDTHS) * FILTERS
    params = {"embedding": rng.normal(0, 0.5, (_CLASSES, DIMENSIONS)), "out": rng.normal(0, 0.3, (count, max(1, len(known))))}
    params |= {f"w{w}": rng.normal(0, 0.3, (w * DIMENSIONS, FILTERS)) for w in WIDTHS}
    params["bias"] = np.zeros(max(1, len(known)))
    if len(known) > 1:
        adam = Adam(params, RATE)
        rounds = max(EPOCHS, min(60, 20000 // max(1, len(y))))
        for turn in range(rounds):
            adam.rate = RATE * (1 - 0.9 * turn / rounds)
            order = rng.permutation(len(y))
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                adam.update(_step(params, windows[some], y[some]))
    return Model(known, {k: v.astype(np.float32) for k, v in params.items()})


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """language, key and window for all windows of the rows to learn from; texts without a letter have none."""
    for batch in batches:
        for row, data, offsets in groups(batch.column(2)):
            windows, first = windows_of(data, offsets)
            count = np.diff(first) * has_letter(data, offsets)
            owner = np.repeat(np.arange(len(count)), count)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            ids = batch.column(0).take(pa.array(owner + row, pa.int64()))
            keys = pa.array([f"{i}:{n}" for i, n in zip(ids.to_pylist(), inside.tolist(), strict=True)], pa.string())
            found = pa.array([w.tobytes() for w in windows[first[owner] + inside]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(owner + row, pa.int64())), keys, found], ["lang", "key", "window"])


def learn(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from texts with a language: of every language at most ROWS_PER_LANGUAGE rows and WINDOWS_PER_LANGUAGE of their windows.

    Both are chosen by hash, any place of any text as likely as another. Rows without text, language or id are left out.
    """
    known = docs.select(F.col(doc).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    known = known.where("_id is not null and _text is not null and _lang is not null")
    ids = sampled(known.select("_id", "_lang"), "_lang", "_id", ROWS_PER_LANGUAGE)
    # So many ids a language that they may go to every task.
    rows = known.join(F.broadcast(ids), ["_id", "_lang"], "left_semi").select(F.col("_id").cast("string"), "_lang", "_text")
    windows = materialize(rows.mapInArrow(trimmed(_window_rows), "lang string, key string, window binary"), "language_windows")
    some = sampled(windows, "lang", "key", WINDOWS_PER_LANGUAGE).select("lang", "window")
    table = some.toArrow().sort_by([("lang", "ascending"), ("window", "ascending")])
    chosen = np.frombuffer(b"".join(table["window"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    return fit(chosen, table["lang"].to_pylist())


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score, the mean share of that language over all windows of the text.

    Null texts and texts without a letter are undetermined with score 1; so is all
    with score 0 where no language was learned. Ties go to the language first in the
    alphabet. Columns of docs called lang_pred or score, in any case, are replaced.
    """
    # Plain arrays travel, so that executors need no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**shared.value)
        tables, languages = known.tables(), [*known.names, UNDETERMINED]
        for batch in batches:
            for row, data, offsets in groups(batch.column(at)):
                windows, first = windows_of(data, offsets)
                letters = has_letter(data, offsets)
                if known.names:
                    p = np.concatenate(
                        [known.probabilities(windows[i : i + WINDOWS_AT_ONCE], tables) for i in range(0, len(windows), WINDOWS_AT_ONCE)]
                    )
                    mean = np.add.reduceat(p.astype(np.float64), first[:-1], axis=0) / np.diff(first)[:, None]
                    best, share = mean.argmax(axis=1), mean.max(axis=1)
                else:
                    best, share = np.zeros(len(letters), np.int64), np.zeros(len(letters))
                best = np.where(letters, best, len(known.names))
                share = np.where(letters, np.minimum(share, 1.0), 1.0)
                own = [c.slice(row, len(best)) for c in batch.columns]
                more = [pa.array(languages, pa.string()).take(pa.array(best)), pa.array(share)]
                yield pa.RecordBatch.from_arrays(own + more, [*names, "lang_pred", "score"])

    kept = docs.select(*names)
    fields = [*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return kept.mapInArrow(trimmed(run), T.StructType(fields))
