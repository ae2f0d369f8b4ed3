"""Mergeable summaries of call records: what shards or runs kept apart adds up to the summary of all their calls.

A partial has, for each model, the sums of its calls, the merged intervals in which it was busy, and the steps by which
its concurrency went up and down. Sums add, intervals merge again, steps add at equal times; so partials of any cut of the calls, merged in
any order, give what intervals.summary gives over all. Call maps are the same summaries as one map a run.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.operators import intervals

SUMS = ("count", "errors", "input_tokens", "output_tokens", "compute_s")
# The fields of a model's entry, as zeros stand for a model without calls.
ENTRY = "count long, errors long, input_tokens long, output_tokens long, compute_time_s double, wall_clock_time_s double, avg_call_s double, max_concurrent long"
TOTALS = "input long, output long, total long"


@dataclass
class Partial:
    """sums(key, SUMS), busy(key, started_at, ended_at) and steps(key, at, step)."""

    sums: DataFrame
    busy: DataFrame
    steps: DataFrame


def partial(calls: DataFrame, key: str = "model") -> Partial:
    """The partial of calls(key, started_at, ended_at, input_tokens, output_tokens, errored)."""
    good = calls.where(~F.coalesce(F.col("errored"), F.lit(False)))
    return Partial(intervals.call_totals(calls, key).select(key, *SUMS), _named(intervals.disjoint(good, key), key), intervals.steps(good, key))


def merged(partials: list[Partial], key: str = "model") -> Partial:
    all_of = lambda part: reduce(DataFrame.unionByName, (getattr(p, part) for p in partials))
    return Partial(all_of("sums").groupBy(key).agg(*(F.sum(c).alias(c) for c in SUMS)), _named(intervals.disjoint(all_of("busy"), key), key), intervals.added(all_of("steps"), key))


def _named(busy: DataFrame, key: str) -> DataFrame:
    return busy.select(key, F.col("s").alias("started_at"), F.col("e").alias("ended_at"))


def finished(p: Partial, key: str = "model") -> DataFrame:
    """The rows of intervals.summary."""
    wall = p.busy.groupBy(key).agg(F.sum(F.col("ended_at") - F.col("started_at")).alias("wall_s"))
    out = p.sums.join(wall, key, "left").join(intervals.peak_of(p.steps, key), key, "left")
    return out.select(
        key, "count", "errors", "input_tokens", "output_tokens",
        F.round("compute_s", 3).alias("compute_time_s"),
        F.round(F.coalesce("wall_s", F.lit(0.0)), 3).alias("wall_clock_time_s"),
        F.round(F.col("compute_s") / F.col("count"), 3).alias("avg_call_s"),
        F.coalesce("peak", F.lit(0)).cast("long").alias("max_concurrent"),
    )


def call_maps(summaries: DataFrame, runs: DataFrame, run: str = "run_id", key: str = "model") -> DataFrame:
    """(run, llm_calls map of ENTRY by model, token_totals) of each of the runs; an empty map and zeros for a run without calls."""
    names = [f.split(" ")[0] for f in ENTRY.split(", ")]
    made = summaries.groupBy(run).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, F.struct(*names))))).alias("llm_calls"), F.sum("input_tokens").alias("i"), F.sum("output_tokens").alias("o"))
    zero = F.lit(0).cast("long")
    total = F.struct(F.coalesce("i", zero).alias("input"), F.coalesce("o", zero).alias("output"), (F.coalesce("i", zero) + F.coalesce("o", zero)).alias("total"))
    return runs.select(run).distinct().join(made, run, "left").select(run, F.coalesce("llm_calls", F.create_map().cast(f"map<string, struct<{', '.join(f.replace(' ', ': ') for f in ENTRY.split(', '))}>>")).alias("llm_calls"), total.alias("token_totals"))


def merged_maps(a: Column, b: Column) -> Column:
    """Two maps of numbers added by key; a key that one lacks counts as zero there."""
    none = F.create_map().cast("map<string,double>")
    return F.map_zip_with(F.coalesce(a, none), F.coalesce(b, none), lambda _, x, y: F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0)))
