"""State of many keys kept together, for streams whose keys get few rows each.

Calling a Python processor costs about ten exchanges with the state store, whether it is
given one row or thousands. With one call per key and batch a log of many users spends
nearly all its time on those calls. Here keys are dealt to a fixed number of shards; a
processor is called once per shard and batch and walks through its keys in order of time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Shards of a stream. More of them make each smaller; a checkpoint keeps its number.
SHARDS = 1024

#: Keys travel as text that gives back every value: NULLs are named, times keep microseconds.
_TEXT = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

Walk = Callable[[tuple | None, list[tuple]], tuple[tuple | None, list[tuple]]]
Due = Callable[[tuple], int | None]
Lapse = Callable[[tuple], tuple[tuple | None, list[tuple]]]


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


def _shard_processor(
    fields: Sequence[str], state: str, out: str, walk: Walk, due: Due, lapse: Lapse
) -> StatefulProcessor:
    """Processor of one shard. State is one row per key that has any.

    Defined inside a function so that it travels to the workers by value.
    """
    columns, result = ["_key", *fields], Row("_key", *_names(out))

    class Shard(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.kept = handle.getListState("kept", f"_key string, {state}")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            new, places = {}, None
            for row in rows:
                places = places or [row.__fields__.index(c) for c in columns]
                name, *values = [row[i] for i in places]
                new.setdefault(name, []).append(tuple(values))
            held, out = self.load(), []
            for name, values in new.items():
                values.sort(key=lambda v: v[0])
                self.take(held, name, *walk(held.pop(name, None), values), out)
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.store(held)
            yield from out

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            now, held, out = timerValues.getCurrentWatermarkInMs(), self.load(), []
            for name in [n for n, s in held.items() if (at := due(s)) is not None and at < now]:
                self.take(held, name, *lapse(held.pop(name)), out)
            self.store(held)
            yield from out

        def load(self) -> dict[str, tuple]:
            return {r[0]: tuple(r[1:]) for r in self.kept.get()} if self.kept.exists() else {}

        def take(self, held, name, left, found, out) -> None:
            if left is not None:
                held[name] = left
            out.extend(result(name, *values) for values in found)

        def store(self, held: dict[str, tuple]) -> None:
            if held:
                self.kept.put([(n, *s) for n, s in held.items()])
            else:
                self.kept.clear()
            times = [at for at in map(due, held.values()) if at is not None]
            if times:
                self.handle.registerTimer(min(times))

        def close(self) -> None:
            pass

    return Shard()


def walk_keys(
    rows: DataFrame,
    keys: Sequence[str],
    event_time: str,
    fields: Sequence[str],
    state: str,
    out: str,
    walk: Walk,
    due: Due,
    lapse: Lapse,
    shards: int = SHARDS,
) -> DataFrame:
    """The keys and the columns ``out`` that walking through each key's rows gives.

    ``walk`` gets a key's state (None at first) and its rows of the batch, tuples of
    ``fields`` in order of the first; it returns the state left, None for none, and rows
    of ``out``. Once the watermark has passed ``due(state)``, in milliseconds, ``lapse`` gets the
    state and returns the same two. All three are given as nested functions, which
    travel by value. A key's results are those it would have alone.
    """
    key_type = T.StructType([T.StructField(f"_{n}", rows.schema[k].dataType) for n, k in enumerate(keys)])
    named = F.struct(*[F.col(k).alias(f"_{n}") for n, k in enumerate(keys)])
    dealt = rows.select(event_time, F.to_json(named, _TEXT).alias("_key"), *fields).withColumn(
        "_shard", F.pmod(F.xxhash64("_key"), F.lit(shards).cast("bigint"))
    )
    walked = dealt.groupBy("_shard").transformWithState(
        statefulProcessor=_shard_processor(fields, state, out, walk, due, lapse),
        outputStructType=f"_key string, {out}",
        outputMode="append",
        timeMode="eventtime",
    )
    named = F.from_json("_key", key_type, _TEXT)
    return walked.withColumn("_key", named).select(
        *[F.col("_key")[f"_{n}"].alias(k) for n, k in enumerate(keys)], *_names(out)
    )
