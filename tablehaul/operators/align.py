"""Comparing results without keys when some columns carry rounding noise.

Rows that are equal cancel out first. What is left of both sides is sorted together by its exact
columns and the first column with a tolerance, in range partitions. Where neighbours differ by
more than the tolerance, or in an exact column, a cluster ends, so partners always lie in one
cluster, and both sides of it are paired in their order. Clusters inside a range partition are
paired where they lie, many at a time. A partition's first and last cluster may go on in its
neighbours: they are tied together through one row per partition, dealt by cluster and paired as
they stream by, and so are very long clusters; only rows that may still find a partner are held.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tablehaul.operators.validate import result_compare
from tablehaul.session import saved

#: Rows of one range partition.
SLOT_ROWS = 500_000
#: Rows of a cluster that are held until it ends; a longer one is dealt and streams.
HELD_ROWS = 100_000
#: Hashes of a row's exact columns.
_GROUP = ["_group", "_group2"]
NESTED = (ArrayType, MapType, StructType, VariantType)


def _near(a: float, b: float, limit: float) -> bool:
    """Whether two neighbours may be partners, whichever of them is the source."""
    return a == b or abs(a - b) <= limit * max(abs(a), abs(b))


def _floats(rows: pa.RecordBatch, i: int) -> np.ndarray:
    return rows.column(f"_v{i}").to_numpy(zero_copy_only=False)


def _begins(rows: pa.RecordBatch, limit: float) -> np.ndarray:
    """Places at which a cluster of sorted rows begins, other than the first."""
    v = _floats(rows, 0)
    a, b = v[:-1], v[1:]
    with np.errstate(invalid="ignore", over="ignore"):
        near = (a == b) | (np.abs(a - b) <= limit * np.maximum(np.abs(a), np.abs(b)))
    for name in _GROUP:
        group = rows.column(name).to_numpy(zero_copy_only=False)
        near &= group[:-1] == group[1:]
    return np.flatnonzero(~near) + 1


class _Pairing:
    """Pairs the rows of sorted clusters, which come one by one."""

    def __init__(self, limits: list[float]):
        self.limits = limits
        self.waiting: dict[bool, list[tuple]] = {True: [], False: []}

    def partners(self, source: tuple, target: tuple) -> bool:
        return all(
            a == b or abs(a - b) <= abs(a) * limit
            for a, b, limit in zip(source, target, self.limits)
        )

    def add(self, row: int, is_source: bool, n: int, values: tuple) -> list[tuple[int, int]]:
        """Rows, with their copies, that can no longer find a partner."""
        alone, kept = [], []
        for other in self.waiting[not is_source]:
            pair = (values, other[2]) if is_source else (other[2], values)
            if n and self.partners(*pair):
                taken = min(n, other[1])
                n -= taken
                other = (other[0], other[1] - taken, other[2])
            if not other[1]:
                continue
            # Values only grow from here, so who is too far now stays too far.
            first = pair[0][0], pair[1][0]
            if abs(first[0] - first[1]) <= abs(first[0]) * self.limits[0] or first[0] == first[1]:
                kept.append(other)
            else:
                alone.append(other[:2])
        self.waiting[not is_source] = kept
        if n:
            self.waiting[is_source].append((row, n, values))
        return alone

    def end(self) -> list[tuple[int, int]]:
        """The rows that wait when a cluster ends."""
        alone = [w[:2] for side in self.waiting.values() for w in side]
        self.waiting = {True: [], False: []}
        return alone


def _settled(rows: pa.RecordBatch, limits: list[float]) -> pa.RecordBatch:
    """What is left of whole clusters: rows with the number of copies without a partner."""
    source = rows.column("_source").to_numpy(zero_copy_only=False).astype(bool)
    left = rows.column("_n").to_numpy(zero_copy_only=False).copy()
    values = [_floats(rows, i) for i in range(len(limits))]
    starts = np.concatenate([[0], _begins(rows, limits[0])])
    sizes = np.diff(starts, append=rows.num_rows)
    # Most clusters are a row of either side.
    a = starts[sizes == 2]
    a = a[source[a] != source[a + 1]]
    s, t = np.where(source[a], a, a + 1), np.where(source[a], a + 1, a)
    fit = np.ones(len(a), bool)
    with np.errstate(invalid="ignore", over="ignore"):
        for v, limit in zip(values, limits):
            fit &= (v[s] == v[t]) | (np.abs(v[s] - v[t]) <= np.abs(v[s]) * limit)
    s, t = s[fit], t[fit]
    taken = np.minimum(left[s], left[t])
    left[s] -= taken
    left[t] -= taken
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        own = slice(start, start + size)
        pairing, rest = _Pairing(limits), []
        held = zip(range(start, start + size), source[own].tolist(), left[own].tolist(),
                   zip(*(v[own].tolist() for v in values)))
        for row in held:
            rest += pairing.add(*row)
        left[own] = 0
        for row, n in rest + pairing.end():
            left[row] = n
    kept = np.flatnonzero(left)
    out = rows.take(pa.array(kept))
    return out.set_column(out.schema.get_field_index("_n"), "_n", pa.array(left[kept]))


def _joined(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches as one; none without rows."""
    rows = [r for r in rows if r.num_rows]
    if rows:
        yield from pa.Table.from_batches(rows).combine_chunks().to_batches()


def _label(limits: list[float], held_rows: int):
    """Pair the clusters inside a sorted partition and number the others.

    Rows of the first cluster have the number 0 and those of the last one the greatest; what is
    left of paired clusters has none.
    """
    def numbered(rows: pa.RecordBatch, number: int | None) -> pa.RecordBatch:
        return rows.append_column("_cluster", pa.array([number] * rows.num_rows, pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The cluster that may go on in the next batch: its rows so far, unless they were passed
        # on with its number, and its last row.
        held: list[pa.RecordBatch] = []
        number, passed_on, last = 0, True, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                starts = _begins(batch, limits[0])
            else:
                (both,) = _joined([last, batch])
                starts = _begins(both, limits[0]) - 1
            last = batch.slice(batch.num_rows - 1)
            if len(starts):
                first, final = int(starts[0]), int(starts[-1])
                head = batch.slice(0, first)
                if passed_on:
                    yield numbered(head, number)
                    whole = [batch.slice(first, final - first)]
                else:
                    whole = [*held, batch.slice(0, final)]
                for rows in _joined(whole):
                    yield numbered(_settled(rows, limits), None)
                held, passed_on, batch = [], False, batch.slice(final)
            held.append(batch)
            if not passed_on and sum(r.num_rows for r in held) > held_rows:
                passed_on, number = True, number + 1
            if passed_on:
                yield from (numbered(r, number) for r in held)
                held = []
        if held:
            yield from (numbered(r, number + 1) for r in held)

    return run


def _pair(limits: list[float]):
    """Pair the rows of sorted clusters; yields the copies of each row that find no partner."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cluster, pairing = None, _Pairing(limits)
        names = [f"_v{i}" for i in range(len(limits))]
        for part in parts:
            alone: list[tuple[int, int]] = []
            rows = zip(part["_home"], part["_number"], part["_id"], part["_source"], part["_n"],
                       zip(*(part[n] for n in names)))
            for home, number, *row in rows:
                if (home, number) != cluster:
                    alone += pairing.end()
                    cluster = home, number
                alone += pairing.add(*row)
            yield pd.DataFrame(alone, columns=["_id", "_left"], dtype="int64")
        yield pd.DataFrame(pairing.end(), columns=["_id", "_left"], dtype="int64")

    return run


def _groups(columns: list[Column], nested: list[bool]) -> dict[str, Column]:
    """Two independent 64-bit hashes of values and of which of them are NULL.

    Different rows of 10^9 agree in both with a chance below 10^-20.
    """
    flat = [
        F.to_json(F.struct(c.alias("c")), {"ignoreNullFields": "false"}) if deep else c
        for c, deep in zip(columns, nested)
    ]
    missing = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in flat])
    return {name: F.xxhash64(F.lit(i), missing, *flat) for i, name in enumerate(_GROUP)}


def _ties(edges: list, limit: float) -> dict[int, tuple[int, int]]:
    """For partitions whose first cluster goes on from the one before: where that began."""
    home: dict[int, tuple[int, int]] = {}
    before = None
    for e in sorted(edges, key=lambda e: e["_slot"]):
        if before is not None:
            (g, v), (last_g, last_v) = e["first"], before["last"]
            if g == last_g and _near(last_v, v, limit):
                at = before["_slot"], before["clusters"]
                home[e["_slot"]] = home[at[0]] if at[1] == 0 and at[0] in home else at
        before = e
    return home


def result_compare_unkeyed(
    source: DataFrame, target: DataFrame, tolerance: dict[str, float], slot_rows: int = SLOT_ROWS,
    held_rows: int = HELD_ROWS,
) -> DataFrame:
    """Rows of one result without a partner in the other: ``only_in, surplus`` and the columns.

    ``tolerance`` gives numeric columns their limit relative to the source's value; all other
    columns are compared exactly. Equal rows are partners first, the rest are paired in order. A
    NULL or NaN is a partner of the same only. Repeated rows count as often as they occur.
    """
    columns = source.columns
    names, limits = list(tolerance), list(tolerance.values())
    values = [F.col(c).cast("double") for c in names]
    odd = [F.when(v.isNull(), 1).when(F.isnan(v), 2).otherwise(0) for v in values]
    exact = [F.col(c) for c in columns if c not in tolerance]
    unequal = result_compare(source, target)
    nested = [isinstance(unequal.schema[c].dataType, NESTED) for c in columns if c not in tolerance]
    groups = _groups([*exact, *odd], [*nested, *[False] * len(odd)])
    left = saved(unequal.withColumns({"_id": F.monotonically_increasing_id()} | groups), "unequal")
    rows = left.select(
        "_id", *_GROUP, (F.col("only_in") == "source").alias("_source"),
        F.col("surplus").alias("_n"),
        *[F.when(o == 0, v).otherwise(0.0).alias(f"_v{i}") for i, (v, o) in enumerate(zip(values, odd))],
    )
    slots = max(1, math.ceil(left.count() / slot_rows))
    order = [*_GROUP, "_v0", "_id"]
    dealt = rows.repartitionByRange(slots, *order).sortWithinPartitions(*order)
    kinds = ", ".join(f"{n} {k}" for n, k in rows.dtypes)
    labelled = saved(
        dealt.mapInArrow(_label(limits, held_rows), f"{kinds}, _cluster long")
        .withColumn("_slot", F.spark_partition_id()), "clusters",
    )
    settled = labelled.filter("_cluster IS NULL").select("_id", F.col("_n").alias("_left"))
    open_rows = labelled.filter("_cluster IS NOT NULL")
    at = F.struct(F.struct(*_GROUP).alias("_group"), "_v0")
    edges = open_rows.groupBy("_slot").agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.max("_cluster").alias("clusters")
    ).collect()  # one row per partition
    home, number = F.col("_slot"), F.col("_cluster")
    if tied := _ties(edges, limits[0]):
        known = labelled.sparkSession.createDataFrame(
            [(s, *h) for s, h in tied.items()], "_tied int, _to_slot int, _to_cluster long"
        )
        open_rows = open_rows.join(
            F.broadcast(known), (F.col("_slot") == F.col("_tied")) & (F.col("_cluster") == 0), "left"
        )
        home, number = F.coalesce("_to_slot", "_slot"), F.coalesce("_to_cluster", "_cluster")
    clusters = open_rows.withColumns({"_home": home, "_number": number})
    paired = (
        clusters.repartition("_home", "_number").sortWithinPartitions("_home", "_number", "_v0", "_id")
        .mapInPandas(_pair(limits), "_id long, _left long")
    )
    # Stored, so that a join with few rows is planned as one.
    alone = saved(settled.unionByName(paired), "alone")
    return left.join(alone, "_id").select("only_in", F.col("_left").alias("surplus"), *columns)
