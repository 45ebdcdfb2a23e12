"""Which rows of a stream need a new answer: keyed state that expires by event time.

A key's first row is answered, and then the first row that comes ``seconds`` or more after the last answered one. What a key leaves behind is one number,
the second of its last answer. Keys are dealt to a fixed number of buckets by their hash, and the state of a bucket is the table of its keys and
numbers, so Python is called once a bucket and batch, not once a key. A key goes from its table as soon as the watermark has passed its second by
``seconds``: every row still to come is then young enough to be answered anyway. A timer clears the tables of buckets that get no more rows. Rows older
than the watermark are dropped. Time counts in whole seconds; of rows of one key and second the first by time, then by order column, counts.

Nothing is read back but the state. A batch costs its own rows and the living keys of the buckets it meets: a service with small batches and very many
keys wants more buckets. Their number is part of the checkpoint and must not change with it. Repeats within an Arrow batch go before the shuffle, which
spreads the work of a hot key over the tasks that read it; the task that owns a bucket keeps one row per key and second of the micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: The state store that keeps large state on disk. A batch commits its changes only, not the files of the whole store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SECOND, BUCKET = "whole_second", "key_bucket"
#: Buckets that share the keys of a stream.
BUCKETS = 1024
#: Rows gathered before repeats among them are looked for again.
GATHERED = 50_000


def first_of_seconds(rows: pd.DataFrame, keys: list[str], ts: str, order: str) -> pd.DataFrame:
    repeated = rows.duplicated(keys, keep=False).to_numpy()
    if not repeated.any():
        return rows
    firsts = rows[repeated].sort_values([ts, order], kind="stable").drop_duplicates(keys)
    return pd.concat([rows[~repeated], firsts])


def without_repeats(batch: pa.RecordBatch, keys: list[str], ts: str, order: str) -> pa.RecordBatch:
    """The first row of every key and second. Only repeated rows are looked at beyond their keys."""
    repeated = batch.select(keys).to_pandas().duplicated(keys, keep=False).to_numpy()
    if not repeated.any():
        return batch
    places = np.flatnonzero(repeated)
    rows = batch.take(pa.array(places))
    frame = rows.select([*keys, order]).to_pandas().assign(_at=rows.column(ts).cast(pa.int64()).to_numpy(), _place=places)
    firsts = first_of_seconds(frame, keys, "_at", order)["_place"].to_numpy()
    return batch.take(pa.array(np.sort(np.concatenate([np.flatnonzero(~repeated), firsts]))))


def answered(keys: np.ndarray, seconds: np.ndarray, last: np.ndarray, known: np.ndarray, valid: int) -> np.ndarray:
    """Places that need an answer, of rows ascending by key (0, 1, ...) and second. ``last`` holds the last answer of the ``known`` keys, and is updated."""
    low, span = int(seconds.min()), int(seconds.max()) - int(seconds.min()) + valid + 2
    at_line = keys * span + (seconds - low)  # all keys on one line, too far apart to reach the next
    who = np.unique(keys)
    start = np.where(known[who], np.clip(last[who] + valid - low, 0, span - 1), 0)
    at, found = np.searchsorted(at_line, who * span + start), []
    while len(at):
        mine = at < len(keys)
        at, who = at[mine], who[mine]
        mine = keys[at] == who
        at, who = at[mine], who[mine]
        found.append(at)
        last[who], known[who] = seconds[at], True
        at = np.searchsorted(at_line, at_line[at] + valid)
    return np.sort(np.concatenate(found))


def answered_places(seconds: np.ndarray, last: int | None, valid: int) -> list[int]:
    """Places of one key's ascending ``seconds`` that need an answer, when ``last`` was answered before."""
    if not len(seconds):
        return []
    return answered(np.zeros(len(seconds), dtype=np.int64), seconds, np.array([last or 0]), np.array([last is not None]), valid).tolist()


def _gathered(parts: Iterator[pd.DataFrame], keys: list[str], ts: str, order: str) -> pd.DataFrame:
    """One row per key and second of a bucket, which may come in many parts."""
    held, kept = [], 0
    for part in parts:
        held.append(part)
        if sum(map(len, held)) > 2 * kept + GATHERED:
            held = [first_of_seconds(pd.concat(held, ignore_index=True), keys, ts, order)]
            kept = len(held[0])
    return first_of_seconds(pd.concat(held, ignore_index=True) if len(held) > 1 else held[0], keys, ts, order)


def _stored(keys: pd.Index, seconds: np.ndarray) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(seconds)], ["key", "second"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def rows_to_answer(
    stream: DataFrame, key: str, ts: str, order: str, seconds: int, late: str = "1 hour", buckets: int = BUCKETS
) -> DataFrame:
    """The rows of a stream that need a new answer, with all their columns. Rows without key or time are left out.

    Meant for append mode. ``late`` is how far rows may come behind the newest one seen.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # the names inside are free of clashes with the whole second and the bucket
    plain = {name: f"c{i}" for i, name in enumerate(stream.columns)}
    key, ts, order = plain[key], plain[ts], plain[order]
    renamed = stream.toDF(*plain.values())
    timed = renamed.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumns(
        {SECOND: F.unix_seconds(ts), BUCKET: F.pmod(F.xxhash64(key), F.lit(buckets))}
    )

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (without_repeats(batch, [key, SECOND], ts, order) for batch in batches)

    combined = timed.mapInArrow(combine, timed.schema).withWatermark(ts, late)

    def answer(_, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = _gathered(parts, [key, SECOND], ts, order)
        names, n_before = rows[key], 0
        if state.exists:
            before = pa.ipc.open_stream(pa.py_buffer(bytes(state.get[0]))).read_all().to_pandas()
            names, n_before = pd.concat([before["key"], names], ignore_index=True), len(before)
        codes, names = pd.factorize(names)
        last, known = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=bool)
        if n_before:
            last[codes[:n_before]], known[codes[:n_before]] = before["second"].to_numpy(), True
        codes, at = codes[n_before:], rows[SECOND].to_numpy()
        sorted_by = np.lexsort((at, codes))
        places = answered(codes[sorted_by], at[sorted_by], last, known, seconds)
        living = (last + seconds) * 1000 > state.getCurrentWatermarkMs()
        if living.any():
            state.update((_stored(names[living], last[living]),))
            state.setTimeoutTimestamp(int(last[living].max() + seconds) * 1000)
        else:
            state.remove()
        if len(places):
            yield rows.iloc[sorted_by[places]]

    result = combined.groupBy(BUCKET).applyInPandasWithState(
        answer, timed.schema, "living binary", "append", GroupStateTimeout.EventTimeTimeout
    )
    return result.drop(SECOND, BUCKET).toDF(*plain)
