"""Flow rollup and windowed group statistics.

Every rule statistic is a count, a sum or a distinct count per (key, window), so the raw
flows are reduced once to a rollup at the widest slot that divides all windows in use. The
rollup's grouping key is the whole (source, target, port, protocol, service, slot) tuple:
a flooded victim or a noisy source spreads over all partitions, and repeated connections
are combined before the shuffle. All later statistics read the rollup.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from flowvigil.functions import flow
from flowvigil.functions.coercion import number_or_zero, text_or, whole_or_zero
from flowvigil.staging import NoStaging, Staging

GRAIN = ("orig_h", "resp_h", "resp_p", "proto", "service", "echo_like", "slot")
COUNTS = ("n", "fails", "successes", "orig_pkts", "resp_pkts")
SUMS = ("syn", "duration", "orig_bytes", "resp_bytes")


def _text(df: DataFrame, name: str) -> Column:
    return text_or(name, "-") if name in df.columns else F.lit("-")


def _whole(df: DataFrame, name: str, dtype: str) -> Column:
    kind = dict(df.dtypes).get(name)
    if kind is None:
        return F.lit(0).cast(dtype)
    # A column that already has the type needs no parsing.
    return F.coalesce(F.col(name), F.lit(0).cast(dtype)) if kind == dtype else whole_or_zero(name, dtype)


def _real(df: DataFrame, name: str) -> Column:
    return number_or_zero(name) if name in df.columns else F.lit(0.0)


def rule_input(flows: DataFrame) -> DataFrame:
    """Flows with every column the rules need: bad numbers are 0, missing text is '-'."""
    columns = {
        name: _text(flows, name)
        for name in ("orig_h", "resp_h", "proto", "service", "conn_state", "history")
    }
    columns |= {name: _real(flows, name) for name in ("ts", "duration", "orig_bytes", "resp_bytes")}
    columns |= {
        "resp_p": _whole(flows, "resp_p", "int"),
        "orig_pkts": _whole(flows, "orig_pkts", "bigint"),
        "resp_pkts": _whole(flows, "resp_pkts", "bigint"),
    }
    columns["syn_noack"] = (
        number_or_zero("syn_noack")
        if "syn_noack" in flows.columns
        else flow.syn_noack(columns["history"])
    )
    return flows.select(*[c.alias(name) for name, c in columns.items()])


def rollup(flows: DataFrame, slot_seconds: int) -> DataFrame:
    """Counts and sums of the flows per grain tuple and slot of ``slot_seconds``."""
    rows = rule_input(flows).select(
        "orig_h",
        "resp_h",
        "resp_p",
        F.lower("proto").alias("proto"),
        F.lower("service").alias("service"),
        # Only ICMP rules look at it; keeping it constant elsewhere keeps the grain coarse.
        (
            flow.echo_like("history")
            & ((F.lower("proto") == "icmp") | (F.lower("service") == "icmp"))
        ).alias("echo_like"),
        flow.time_bin("ts", slot_seconds).alias("slot", metadata={"seconds": slot_seconds}),
        flow.failed("conn_state").cast("bigint").alias("fails"),
        flow.succeeded("conn_state").cast("bigint").alias("successes"),
        F.col("syn_noack").alias("syn"),
        "orig_pkts",
        "resp_pkts",
        "duration",
        "orig_bytes",
        "resp_bytes",
    )
    sums = [F.sum(name).alias(name) for name in COUNTS[1:] + SUMS]
    return rows.groupBy(*GRAIN).agg(F.count("*").alias("n"), *sums)


def with_windows(rows: DataFrame, short: int, long: int) -> DataFrame:
    """Add the starts of the short and the long window that hold each slot.

    A window that the rollup's slot doesn't divide would cut through slots and is an error.
    """
    seconds = rows.schema["slot"].metadata.get("seconds")
    if seconds and (short % seconds or long % seconds):
        raise ValueError(f"windows of {short} and {long} s are no multiples of the slot of {seconds} s")
    return rows.withColumns(
        {"short_bin": flow.rebin("slot", short), "long_bin": flow.rebin("slot", long)}
    )


# Statistics over rollup rows.


def rows_total() -> Column:
    return F.sum("n")


def fails_total() -> Column:
    return F.sum("fails")


def successes_total() -> Column:
    return F.sum("successes")


def distinct_ports() -> Column:
    return F.countDistinct("resp_p")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


# The statistics a scope can ask for, over rollup rows: sums, and counts of different values.
SUMMED = ("n", "fails", "successes", "syn", "orig_pkts", "resp_pkts", "duration", "orig_bytes", "resp_bytes")
DISTINCT = {
    "hosts": ("resp_h",),
    "ports": ("resp_p",),
    "pairs": ("resp_h", "resp_p"),
    "sources": ("orig_h",),
    "source_ports": ("orig_h", "resp_p"),
}


def exact_statistics(rows: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``names`` (of SUMMED and DISTINCT) per group of ``keys``, with exact counts of different values.

    The group's sets of values are rows, and sets are merged by grouping them again: one row per key and pair, then
    one per key and host, then one per key. A row counts in every later step, so sums go along and no row is
    copied. A set that is not part of a larger one goes its own way and meets the others by key. Every step
    combines before its shuffle, and a hot key is in one task only when it is a single row per task.
    """
    sums = [name for name in names if name in SUMMED]
    sets = sorted((name for name in names if name in DISTINCT), key=lambda x: -len(DISTINCT[x]))
    chain: list[str] = []
    for name in sets:
        if not chain or set(DISTINCT[name]) < set(DISTINCT[chain[-1]]):
            chain.append(name)
    groups, counted = rows, []
    for name in chain:
        carried = [F.sum(c).alias(c) for c in (*sums, *counted)]
        groups = groups.groupBy(*keys, *DISTINCT[name]).agg(*(carried or [F.lit(1).alias("_")]))
        groups, counted = groups.withColumn(name, F.lit(1).cast("bigint")), [*counted, name]
    groups = groups.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*sums, *counted)])
    for name in sets:
        if name not in chain:
            alone = rows.groupBy(*keys, *DISTINCT[name]).agg(F.lit(1).alias("_"))
            groups = groups.join(alone.groupBy(*keys).agg(F.count("*").alias(name)), list(keys))
    return groups.select(*keys, *names)


def slot_sketches(rows: DataFrame, keys: Sequence[str], names: Sequence[str], precision: int = 14) -> DataFrame:
    """Mergeable estimates: a sketch of each set of ``names`` (of DISTINCT) per key and slot, and the slot's ``n``.

    Stored beside the rollup they stand for its flows: any window is their union, so it can be evaluated again, or
    at another width, when the flows are gone. A sketch has at most 2**``precision`` registers, whatever it counts.
    """
    sketches = [F.hll_sketch_agg(F.concat_ws("\t", *[F.col(c).cast("string") for c in DISTINCT[name]]), precision).alias(name) for name in names]
    return rows.groupBy(*keys, "slot").agg(F.sum("n").alias("n"), *sketches)


def window_estimates(sketches: DataFrame, keys: Sequence[str], names: Sequence[str], seconds: int) -> DataFrame:
    """n and the estimated counts per key and window of ``seconds``, from stored ``slot_sketches``."""
    merged = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names]
    return sketches.groupBy(*keys, flow.rebin("slot", seconds).alias("bin")).agg(F.sum("n").alias("n"), *merged)


@dataclass(frozen=True)
class Scope:
    """Statistics of one key in the short or the long window.

    ``keep`` sees the statistics under their own names and must be true for every group
    that can make a row a hit; groups that fail it are dropped before the join. Joined
    back, statistic ``s`` of scope ``v`` is column ``v_s``.
    """

    name: str
    keys: Sequence[str]
    window: str
    stats: Sequence[str]
    keep: Column

    @property
    def bin(self) -> str:
        return f"{self.window}_bin"


@dataclass(frozen=True)
class Detection:
    """One detector: the rows it looks at, its scopes, and its alerts from the kept groups."""

    label: str
    rows: DataFrame
    scopes: Sequence[Scope]
    alerts: Callable[[dict[str, DataFrame]], DataFrame]


def group_statistics(rows: DataFrame, keys: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[stat.alias(name) for name, stat in stats.items()])


def _kept_groups(label: str, rows: DataFrame, scope: Scope) -> DataFrame:
    """The kept groups of a scope."""
    groups = exact_statistics(rows.withColumn("bin", F.col(scope.bin)), [*scope.keys, "bin"], scope.stats)
    return groups.where(scope.keep).select(
        F.lit(f"{label}.{scope.name}").alias("scope"),
        *scope.keys,
        "bin",
        *[F.col(name).cast("double").alias(name) for name in scope.stats],
    )


def run_detections(
    detections: Sequence[Detection], staging: Staging | NoStaging = NoStaging()
) -> list[DataFrame]:
    """Alerts of each detection.

    The kept groups of all scopes of all detections are one staged table, partitioned by
    scope: one job computes them side by side, and the size of each scope's files decides
    whether its join is broadcast.
    """
    parts = [_kept_groups(found.label, found.rows, scope) for found in detections for scope in found.scopes]
    groups = staging.table(
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts),
        "kept-groups",
        partition_by=("scope",),
    )

    def of_scope(label: str, scope: Scope) -> DataFrame:
        return groups.where(F.col("scope") == f"{label}.{scope.name}").select(
            *scope.keys,
            F.col("bin").alias(scope.bin),
            *[F.col(s).alias(f"{scope.name}_{s}") for s in scope.stats],
        )

    return [
        found.alerts({scope.name: of_scope(found.label, scope) for scope in found.scopes})
        for found in detections
    ]


def join_back(
    rows: DataFrame, scopes: Sequence[Scope], groups: dict[str, DataFrame], how: str = "left"
) -> DataFrame:
    """Rows with the statistics of their kept groups; NULL where the group was not kept."""
    return reduce(
        lambda acc, scope: acc.join(groups[scope.name], on=[*scope.keys, scope.bin], how=how),
        scopes,
        rows,
    )
