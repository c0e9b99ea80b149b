"""Change detection on a stream of crawls, with keyed state.

The state of an item is the hash of its body and the crawl that saw it last. A crawl is an event time: an item that a
whole grace period of crawls no longer brings has been removed, which a timer tells when the watermark passes it.
Items are dealt by a hash of their key into parts; the items of a part are one state with one timer, the earliest of
theirs. So Python is asked once for each part that got rows and not once for each item, whose calls would be nearly
all of the time; a part is read and written whole. With Spark's RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``) the state need not fit into memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusflow.workers import ship_by_value

ship_by_value(__name__)

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Parts of the items of a stream.
PARTS = 4096
_OUTPUT, _STATE = "key string, status string, at long", "items binary"


def _read(held: bytes) -> dict[str, tuple[int, int]]:
    table = pa.ipc.open_stream(held).read_all()
    prints, seen = (table.column(c).to_pylist() for c in (1, 2))
    return dict(zip(table.column(0).to_pylist(), zip(prints, seen, strict=True), strict=True))


def _write(items: dict[str, tuple[int, int]]) -> bytes:
    prints, seen = zip(*items.values(), strict=True)
    columns = [pa.array(list(items), pa.string()), pa.array(prints, pa.int64()), pa.array(seen, pa.int64())]
    batch, sink = pa.RecordBatch.from_arrays(columns, ["key", "print", "seen"]), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _tracker(grace: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """new, updated, same and removed of the items of a part, each in the order of its crawls; ``grace`` in milliseconds."""

    def follow(part: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        items = _read(bytes(state.get[0])) if state.exists else {}
        out, arrived = [], []
        if not state.hasTimedOut:
            for frame in rows:
                arrived += zip(frame["at"].tolist(), frame["print"].tolist(), frame["key"].tolist(), strict=True)
        for at, print_, key in sorted(arrived):
            known = items.get(key)
            if known is not None and at < known[1]:
                continue  # an older crawl says nothing about the item as it is
            out.append((key, "new" if known is None else "same" if known[0] == print_ else "updated", at))
            items[key] = (print_, at)
        # What the batch brought counts before what the watermark has passed.
        passed = state.getCurrentWatermarkMs() - grace
        gone = [(key, "removed", seen) for key, (_, seen) in items.items() if seen < passed]
        for key, _, _ in gone:
            del items[key]
        if items:
            state.update((_write(items),))
            state.setTimeoutTimestamp(min(seen for _, seen in items.values()) + grace)
        elif state.exists:
            state.remove()
        if out or gone:
            yield pd.DataFrame(out + gone, columns=["key", "status", "at"])

    return follow


def track(stream: DataFrame, key: str, body: str, time: str, delay: str, grace: str, parts: int = PARTS) -> DataFrame:
    """key, status, seen for every row of a stream of crawled items, and a removed row for items that stay away.

    status: new, updated, same or removed; seen: the crawl, of a removed item its last one. ``grace`` is how long an item may
    stay away, ``delay`` how late a row may come; both are intervals as Spark writes them. Rows older than the item's last
    crawl are left out. A null key or time takes no part; a null body is a body. Items are kept in so many ``parts``, which a
    checkpoint holds on to; a part should be some thousand to some hundred thousand items.
    """
    spark = stream.sparkSession
    milliseconds = spark.range(1).select(F.expr(f"unix_millis(timestamp_seconds(0) + interval {grace})")).first()[0]
    rows = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, delay)
    given = rows.select(
        F.col(key).cast("string").alias("key"), F.col(time), F.unix_millis(time).alias("at"), F.xxhash64(F.col(body).isNull(), body).alias("print")
    )
    timer = GroupStateTimeout.EventTimeTimeout
    given = given.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    found = given.groupBy("part").applyInPandasWithState(_tracker(milliseconds), _OUTPUT, _STATE, "append", timer)
    return found.select("key", "status", F.timestamp_millis("at").alias("seen"))
