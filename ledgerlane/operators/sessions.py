"""Sessions: events of a key that follow each other within a gap.

Events are dealt by ranges of (key, time), so a key with very many events is spread over tasks. A task
walks its range in order and gives a row per session. Only its first and last session can go on in
other ranges; these few, two a range, are put together afterwards.
"""

from __future__ import annotations

import operator
import sys
from collections.abc import Callable, Iterator, Mapping
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.functions import quoted, ref
from ledgerlane.sinks import stage, staging_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MERGES: dict[str, Callable] = {"sum": operator.add, "min": min, "max": max}


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; nulls are equal."""
    before, after = column.slice(0, len(column) - 1), column.slice(1)
    different = pc.fill_null(pc.not_equal(before, after), False)
    return pc.or_(different, pc.xor(pc.is_null(before), pc.is_null(after))).to_numpy(zero_copy_only=False)


def _merge(first: dict, second: dict, kinds: Mapping[str, str]) -> dict:
    """Two parts of one session, the first one earlier."""
    merged = {**first, "end": second["end"], "events": first["events"] + second["events"]}
    for name, kind in kinds.items():
        a, b = first[name], second[name]
        merged[name] = b if a is None else a if b is None else MERGES[kind](a, b)
    return merged


def run_sessions(
    events: DataFrame, key: str, at: str, gap: timedelta, measures: Mapping[str, tuple[str, str]] | None = None
) -> DataFrame:
    """(key, session_start, session_end, events, measures): one row per session.

    A session goes on while the next event of its key comes no later than `gap` after the one before.
    `measures` are named (kind, column) pairs, of the kinds sum, min and max; sums are exact for whole
    numbers and decimals. Null keys are one key; events without a time belong to no session.
    """
    wanted = dict(measures or {})
    for name, (kind, _) in wanted.items():
        if kind not in MERGES:
            raise ValueError(f"{name} is of the unknown kind {kind}")
    aliases = {name: f"m{i}" for i, name in enumerate(wanted)}
    kinds = {aliases[name]: kind for name, (kind, _) in wanted.items()}
    columns = [F.sum(ref(c)).alias(aliases[n]) if kind == "sum" else F.min(ref(c)).alias(aliases[n]) for n, (kind, c) in wanted.items()]
    # The types that Spark's own aggregates would give.
    typed = events.groupBy().agg(F.count(F.lit(1)).alias("events"), *columns).schema
    result_types = {f.name: f.dataType for f in typed}
    rows = events.where(ref(at).isNotNull()).select(
        ref(key).alias("key"),
        ref(at).alias("at"),
        *[ref(c).cast(result_types[aliases[n]]).alias(aliases[n]) for n, (_, c) in wanted.items()],
    )
    allowed = gap // timedelta(microseconds=1)
    names = ["key", "start", "end", "events", *kinds, "edge"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None  # the session that may go on
        first = True
        schema = None

        def made(sessions: list[dict], edges: list[bool]) -> pa.RecordBatch:
            types = {"key": schema.field("key").type, "start": schema.field("at").type, "end": schema.field("at").type, "events": pa.int64()}
            types |= {m: schema.field(m).type for m in kinds}
            arrays = [pa.array([s[n] for s in sessions], t) for n, t in types.items()]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(edges, pa.bool_())], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            times = batch.column("at")
            moments = times.cast(pa.int64()).to_numpy(zero_copy_only=False)
            breaks = _changes(batch.column("key")) | (np.diff(moments) > allowed)
            starts = np.concatenate([[0], np.flatnonzero(breaks) + 1])
            ends = np.append(starts[1:], batch.num_rows)
            numbers = np.repeat(np.arange(len(starts)), ends - starts)
            table = pa.table({"number": numbers, **{m: batch.column(m) for m in kinds}})
            sums = table.group_by("number", use_threads=False).aggregate([(m, kind) for m, kind in kinds.items()]) if kinds else None
            parts = {
                "key": batch.column("key").take(pa.array(starts)).to_pylist(),
                "start": times.take(pa.array(starts)).to_pylist(),
                "end": times.take(pa.array(ends - 1)).to_pylist(),
                "events": (ends - starts).tolist(),
            }
            parts |= {m: sums.column(f"{m}_{kind}").to_pylist() for m, kind in kinds.items()}
            found = [dict(zip(parts, values)) for values in zip(*parts.values())]
            if held is not None:
                near = (found[0]["start"] - held["end"]) // timedelta(microseconds=1) <= allowed
                if found[0]["key"] == held["key"] and near:
                    found[0] = _merge(held, found[0], kinds)
                else:
                    found.insert(0, held)
            held = found.pop()
            if found:
                yield made(found, [first, *[False] * (len(found) - 1)])
                first = False
        if held is not None:
            yield made([held], [True])

    kind_of = {"key": rows.schema["key"], "at": rows.schema["at"]}
    fields = [f"key {kind_of['key'].dataType.simpleString()}"]
    fields += [f"{quoted(n)} {kind_of['at'].dataType.simpleString()}" for n in ("start", "end")]
    fields += ["events long", *[f"{m} {result_types[m].simpleString()}" for m in kinds], "edge boolean"]
    ordered = rows.repartitionByRange("key", "at").sortWithinPartitions("key", "at")
    sessions = stage(ordered.mapInArrow(walk, ", ".join(fields)), f"{staging_folder(events.sparkSession)}/sessions")

    by_time = Window.partitionBy("key").orderBy("start", "end")
    edges = sessions.where("edge")
    # Earlier sessions of a key end earlier, so the one before tells whether this one goes on.
    apart = F.coalesce(F.col("start") - F.lag("end").over(by_time) > F.lit(gap), F.lit(True))
    numbered = edges.withColumn("apart", apart.cast("int")).withColumn("number", F.sum("apart").over(by_time))
    merges = {"sum": F.sum, "min": F.min, "max": F.max}
    merged = numbered.groupBy("key", "number").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.sum("events").alias("events"),
        *[merges[kind](m).cast(result_types[m]).alias(m) for m, kind in kinds.items()],
    )
    whole = sessions.where("not edge").drop("edge").unionByName(merged.drop("number"))
    return whole.select(
        F.col("key").alias(key),
        F.col("start").alias("session_start"),
        F.col("end").alias("session_end"),
        "events",
        *[F.col(m).alias(name) for name, m in aliases.items()],
    )
