"""Stateful steps of a stream: the latest control value, pairing by order of arrival, and heartbeats.

A heartbeat is a row that carries only a time: it moves the watermark on where a source has nothing to
say, above all at the end of an input. Steps pass heartbeats on, so that later steps close as well.

The heavy side of a step is spread over salts, and the control rows, a few per tick, are sent to every
salt; so no key holds more than its share of the rows. State lives in the RocksDB store of the query.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: Parts of the rows that hold their own state; more of them than cores of a cluster gain nothing.
SALTS = 8
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def salt(by: Column | str, salts: int) -> Column:
    return F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")


def _to_every_salt(df: DataFrame, salts: int, name: str) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def _texts(values: Iterable[str | None]) -> pd.Series:
    return pd.Series(list(values), dtype=object)


# --- the latest control value ---------------------------------------------------------------------

class LatestControl(StatefulProcessor):
    """Rows of a salt wait until the watermark has passed them, and for the first control value.

    Rows and values travel as JSON, so that types and nulls stay as they are. Kept are the rows that wait, in packed
    pieces that are read one at a time and only once a row of theirs is due, and of the control values the latest at or
    before the watermark and those after it, as two arrays.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "first bigint, number bigint", "rows binary")
        self.number = handle.getValueState("number", "pieces bigint")
        self.controls = handle.getValueState("controls", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ticks, held = [], []
        number, first = self.number.get()[0] if self.number.exists() else 0, None
        for frame in rows:
            frame = frame[frame["us"].notna()]
            marks = frame[frame["is_control"] & frame["packed"].notna()]  # without a value it is a heartbeat
            if len(marks):
                ticks.append(marks["us"].to_numpy(dtype=np.int64))
                held.append(pa.array(marks["packed"], pa.large_string()))
            fresh = frame[~frame["is_control"]]
            if len(fresh):
                earliest = self._put(fresh["us"].to_numpy(dtype=np.int64), pa.array(fresh["packed"], pa.large_string()), number)
                first, number = earliest if first is None else min(first, earliest), number + 1
        if ticks:
            self._add_controls(ticks, held)
        if first is not None:
            self.number.update((number,))
            self._wake(first, timerValues)
        yield pd.DataFrame({"packed": _texts([]), "generation_s": np.empty(0, dtype=np.int64), "held": _texts([])})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000  # nothing at or before this time comes any more
        pieces = sorted(self.waiting.keys())
        if not pieces:
            return
        ticks, held = self._controls()
        known = len(ticks) > 0 and ticks[0] <= now
        later = [first for first, _ in pieces if first > now or not known]
        for first, number in pieces if known else []:
            if first > now:
                break
            us, packed = pickle.loads(self.waiting.getValue((first, number))[0])
            self.waiting.removeKey((first, number))
            due = us <= now
            if not due.all():
                later.append(self._put(us[~due], packed.filter(pa.array(~due)), number))
            at = np.maximum(np.searchsorted(ticks, us[due], side="right") - 1, 0)  # rows before the first control value take the first
            yield pd.DataFrame(
                {
                    "packed": _texts(packed.filter(pa.array(due)).to_pylist()), "generation_s": ticks[at] // 1_000_000,
                    "held": _texts(held.take(pa.array(at)).to_pylist()),
                }
            )
        if known:
            latest = int(np.searchsorted(ticks, now, side="right")) - 1
            if latest:
                self._keep_controls(ticks[latest:], held.take(pa.array(np.arange(latest, len(ticks)))))
        if later:
            self._wake(min(later), timerValues)

    def _put(self, us: np.ndarray, packed: pa.Array, number: int) -> int:
        """Keeps a piece of waiting rows; its earliest time."""
        first = int(us.min())
        self.waiting.updateValue((first, number), (pickle.dumps((us, packed)),))
        return first

    def _controls(self) -> tuple[np.ndarray, pa.Array]:
        if self.controls.exists():
            return pickle.loads(self.controls.get()[0])
        return np.empty(0, dtype=np.int64), pa.array([], pa.large_string())

    def _keep_controls(self, ticks: np.ndarray, held: pa.Array) -> None:
        self.controls.update((pickle.dumps((ticks, held)),))

    def _add_controls(self, ticks: list[np.ndarray], held: list[pa.Array]) -> None:
        """Adds control values, in the order of their times; of equal times the last one counts."""
        before, old = self._controls()
        times, values = np.concatenate([before, *ticks]), pa.concat_arrays([old, *held])
        distinct, behind = np.unique(times[::-1], return_index=True)
        self._keep_controls(distinct, values.take(pa.array(len(times) - 1 - behind)))

    def _wake(self, us: int, timerValues) -> None:
        """A timer for the first waiting row; for one that only waits for a control value, when time moves on."""
        self.handle.registerTimer(max(-(-us // 1000), timerValues.getCurrentWatermarkInMs() + 1))

    def close(self) -> None:
        pass


def asof_latest(
    rows: DataFrame, control: DataFrame, value: str, time: str = "ts", id: str = "event_id",
    delay: str = "0 seconds", salts: int = SALTS,
) -> DataFrame:
    """Streams: each of ``rows`` with ``generation_s`` and ``value`` of the latest control row at or before it.

    Ticks of ``control (generation_s, value)`` may have gaps; of equal ticks one counts. Rows before the first
    control row wait for it and get it. A row is given out when the watermarks of both streams (``delay``
    behind their latest time) have passed it; rows and control rows that come later than that are
    dropped, rows without a time too. A control row without a value is a heartbeat. For append mode.
    """
    given = rows.where(F.col(time).isNotNull()).withColumn("time_", F.col(time)).withWatermark("time_", delay)
    marks = control.select(F.timestamp_seconds("generation_s").alias("time_"), F.struct(value).alias("_held"))
    left = given.select(
        salt(id, salts).alias("part"), "time_", F.lit(False).alias("is_control"), F.unix_micros("time_").alias("us"),
        F.to_json(F.struct(*rows.columns), _EXACT).alias("packed"),
    )
    held = F.when(F.col(f"_held.{value}").isNotNull(), F.to_json("_held", _EXACT))
    right = _to_every_salt(marks.withWatermark("time_", delay), salts, "part").select(
        "part", "time_", F.lit(True).alias("is_control"), F.unix_micros("time_").alias("us"), held.alias("packed")
    )
    found = left.unionByName(right).groupBy("part").transformWithStateInPandas(
        LatestControl(), "packed string, generation_s bigint, held string", "Append", "EventTime"
    )
    held_type = StructType([control.schema[value]])
    read = found.select(
        F.from_json("packed", rows.schema, _EXACT).alias("_row"), "generation_s",
        F.from_json("held", held_type, _EXACT).alias("_held"),
    )
    return read.select("_row.*", "generation_s", f"_held.{value}")


# --- pairing by order of arrival ------------------------------------------------------------------

class Queue(StatefulProcessor):
    """Two queues under one key: the k-th new generation meets the k-th offer, whichever comes first."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("queues", "packed binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen, generations, offers = pickle.loads(self.state.get()[0]) if self.state.exists() else (set(), [], [])
        frame = pd.concat(list(rows), ignore_index=True)
        beat, offer = frame["kind"] == "beat", frame["kind"] == "offer"
        fresh = sorted(set(frame["at"][~beat & ~offer].tolist()) - seen)
        seen.update(fresh)
        generations += fresh
        offers += sorted(zip(frame["at"][offer].tolist(), frame["packed"][offer]))
        paired = list(zip(generations, offers))
        self.state.update((pickle.dumps((seen, generations[len(paired) :], offers[len(paired) :])),))
        found = [(g, tick, value) for g, (tick, value) in paired]
        found += [(g, g, None) for g in sorted(set(frame["at"][beat].tolist()))]
        at, ticks, values = zip(*found) if found else ((), (), ())
        numbers = {"generation_s": np.array(at, dtype=np.int64), "tick_s": np.array(ticks, dtype=np.int64)}
        yield pd.DataFrame({**numbers, "packed": _texts(values)})

    def close(self) -> None:
        pass


def pair_generations(
    rows: DataFrame, offers: DataFrame, value: str = "tags", id: str = "event_id", salts: int = SALTS
) -> DataFrame:
    """Streams: the k-th distinct ``generation_s`` of ``rows`` with the k-th of ``offers (generation_s, value)``.

    Gives ``generation_s, tick_s, value``, the tick being that of the offer. What has no partner yet waits in
    its queue. What is new in one micro-batch queues in ascending order. Generations are made distinct per
    salt first, so the one task with the queues gets a row per salt and generation. Rows with a null ``id``
    are heartbeats: they are passed on without a value and take no partner. For append mode.
    """
    kind = F.when(F.col(id).isNull(), "beat").otherwise("generation").alias("kind")
    once = rows.select(F.col("generation_s").alias("at"), kind, salt(id, salts).alias("part")).dropDuplicates()
    left = once.select("at", "kind", F.lit(None).cast("string").alias("packed"))
    right = offers.select(
        F.col("generation_s").alias("at"), F.lit("offer").alias("kind"), F.to_json(F.struct(value), _EXACT).alias("packed")
    )
    found = left.unionByName(right).withColumn("queue", F.lit(0)).groupBy("queue").transformWithStateInPandas(
        Queue(), "generation_s bigint, tick_s bigint, packed string", "Append", "None"
    )
    held = F.from_json("packed", StructType([offers.schema[value]]), _EXACT)
    return found.select("generation_s", "tick_s", held[value].alias(value))


def join_pairs(rows: DataFrame, pairs: DataFrame, id: str = "event_id", delay: str = "1 second", salts: int = SALTS) -> DataFrame:
    """Streams: ``rows`` with the pair of their generation, as the event time ``generation`` of what follows.

    Either side waits for the other until both watermarks, which follow the generations, have passed.
    """
    at = F.timestamp_seconds("generation_s")
    left = rows.select(*rows.columns, at.alias("generation"), salt(id, salts).alias("_salt")).withWatermark("generation", delay)
    others = [c for c in pairs.columns if c != "generation_s"]
    right = _to_every_salt(pairs.select(at.alias("_generation"), *others), salts, "_to")
    right = right.withWatermark("_generation", delay)
    met = (F.col("generation") == F.col("_generation")) & (F.col("_salt") == F.col("_to"))
    return left.join(right, met).drop("_generation", "_salt", "_to")
