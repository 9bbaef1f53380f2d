"""Pre-aggregated rollups made of mergeable partial states.

One ``Rollup`` definition drives the backfill, the stream, compaction and every read, so
they cannot drift apart. Counts and sums are plain numbers; distinct counts and quantiles
are sketches that Spark can merge. Averages are a sum and a count, divided on read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rollup:
    """Keys and measures; each measure maps an output name to an input expression."""

    keys: list[str]
    counts: dict[str, str] = field(default_factory=dict)
    sums: dict[str, str] = field(default_factory=dict)
    averages: dict[str, str] = field(default_factory=dict)
    distincts: dict[str, str] = field(default_factory=dict)
    quantiles: dict[str, tuple[str, float]] = field(default_factory=dict)


def rollup_build(df: DataFrame, spec: Rollup) -> DataFrame:
    """One row of partial states per key."""
    states = [F.count(F.expr(e)).alias(n) for n, e in spec.counts.items()]
    states += [F.sum(F.expr(e)).alias(n) for n, e in spec.sums.items()]
    for name, e in spec.averages.items():
        states += [F.sum(F.expr(e)).alias(f"{name}__sum"), F.count(F.expr(e)).alias(f"{name}__n")]
    states += [F.hll_sketch_agg(F.expr(e), 14).alias(f"{n}__hll") for n, e in spec.distincts.items()]
    states += [
        F.kll_sketch_agg_double(F.expr(e).cast("double")).alias(f"{n}__kll")
        for n, (e, _) in spec.quantiles.items()
    ]
    return df.groupBy(*spec.keys).agg(*states)


def _merged(states: DataFrame, spec: Rollup, keys: list[str]) -> DataFrame:
    merges = [F.sum(n).alias(n) for n in [*spec.counts, *spec.sums]]
    for name in spec.averages:
        merges += [F.sum(f"{name}__sum").alias(f"{name}__sum"), F.sum(f"{name}__n").alias(f"{name}__n")]
    merges += [F.hll_union_agg(f"{n}__hll").alias(f"{n}__hll") for n in spec.distincts]
    merges += [F.kll_merge_agg_double(f"{n}__kll").alias(f"{n}__kll") for n in spec.quantiles]
    return states.groupBy(*keys).agg(*merges)


def rollup_compact(states: DataFrame, spec: Rollup) -> DataFrame:
    """Fold all state rows of a key into one; still states, still mergeable."""
    return _merged(states, spec, spec.keys)


def rollup_merge(states: DataFrame, spec: Rollup, by: list[str] | None = None) -> DataFrame:
    """Final values, at the rollup's keys or at any subset of them."""
    keys = spec.keys if by is None else by
    merged = _merged(states, spec, keys)
    values = [F.col(n) for n in [*spec.counts, *spec.sums]]
    for name in spec.averages:
        total, n = F.col(f"{name}__sum"), F.col(f"{name}__n")
        values.append(F.try_divide(total.cast("double"), n).alias(name))
    values += [F.hll_sketch_estimate(f"{n}__hll").alias(n) for n in spec.distincts]
    values += [
        F.kll_sketch_get_quantile_double(f"{n}__kll", F.lit(q)).alias(n)
        for n, (_, q) in spec.quantiles.items()
    ]
    return merged.select(*keys, *values)
