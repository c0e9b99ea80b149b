"""What the numpy-trained models share: an optimizer and the fixed split of rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.workers import ship_by_value

ship_by_value(__name__)


class Adam:
    """Adam over a dict of arrays, changed in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in params.items()}
        self.second = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, g in grads.items():
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            self.params[k] -= scale * self.first[k] / (np.sqrt(self.second[k]) + 1e-8)


def held_out(doc: Column) -> Column:
    """Rows that no model learns from: a fifth, by the checksum of the id as text. A null id is not among them."""
    return F.coalesce(F.crc32(F.encode(doc.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


#: Range of the number that decides which rows are sampled, and how many more than asked for are ranked.
_RANGE, _MORE = 1 << 30, 3


def sampled(rows: DataFrame, by: str, key: str, most: int) -> DataFrame:
    """At most so many rows for each value of a column, by the hash of a key: any row is as likely as another.

    Of a frequent value only the share of rows that will do is ranked, so its rows do not
    meet in one task however many they are. The column must have few values.
    """
    counts = rows.groupBy(by).agg(F.count("*").alias("_count"))
    drawn = rows.join(F.broadcast(counts), by).withColumn("_draw", F.pmod(F.xxhash64(key), F.lit(_RANGE)))
    some = drawn.where(F.col("_draw") * F.col("_count") <= float(_RANGE * _MORE * most))
    order = Window.partitionBy(by).orderBy("_draw", key)
    ranked = some.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= most)
    return ranked.drop("_place", "_draw", "_count")
