"""The live loop as a Structured Streaming query, and stream-native statistics.

Every micro-batch is scored and appended once; the rules then read the look-back window from
the appended table, so their results equal those of the batch run over the same flows. Each
batch writes under its own number and can be repeated after a failure without duplicates.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from flowvigil.config import BanConfig, MergeConfig, RuleProfile
from flowvigil.functions.coercion import epoch_to_timestamp
from flowvigil.operators import alerts as a, detectors as d, response
from flowvigil.schema import BAN_DECISION, MERGED_ALERT, RULE_ALERT, SCORE
from flowvigil.sources.sinks import BanState, append_batch, append_by_day, read_batches, read_since
from flowvigil.staging import Staging


@dataclass(frozen=True)
class LiveRun:
    """One live deployment: where it keeps its tables and how it decides."""

    folder: str
    flow_schema: T.StructType
    profile: RuleProfile
    # Adds ``p_raw`` and ``p_cal`` to a batch of flows.
    score: Callable[[DataFrame], DataFrame]
    threshold: float
    # Without a window: a batch merges all of its alerts, however old a backlog makes them.
    merge: MergeConfig = MergeConfig(cooldown_seconds=300)
    ban: BanConfig = BanConfig(only_latest=True)
    look_back: int | None = None
    max_rows: int | None = None
    allowed: tuple[str, ...] = ()
    # Seconds since the epoch; None takes the newest flow time, which makes replays repeatable.
    clock: Callable[[], float] | None = time.time

    @property
    def scored_schema(self) -> T.StructType:
        known = {*SCORE.names}
        flow = [f for f in self.flow_schema.fields if f.name not in known]
        return T.StructType([*flow, *SCORE.fields])

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        schema = {
            "scored": self.scored_schema,
            "rule_alerts": RULE_ALERT,
            "merged_alerts": MERGED_ALERT,
            "bans": BAN_DECISION,
        }[name]
        return read_batches(spark, self.path(name), schema)


def process_batch(run: LiveRun, flows: DataFrame, batch: int) -> None:
    """Score, store, apply the rules, merge, decide on bans: one micro-batch."""
    spark = flows.sparkSession
    scored = a.with_prediction(run.score(flows), run.threshold)
    # Flagged and passed flows are two partitions of one table, written in one pass.
    append_by_day(
        scored.select(*[F.col(f.name).cast(f.dataType) for f in run.scored_schema.fields]),
        run.path("scored"), batch, "ts", partition_by=("pred",),
    )
    written = run.table(spark, "scored").where(F.col("batch") <= batch)
    if run.clock is None:
        # Only the newest day's files can hold the newest flow.
        last_day = written.agg(F.max("event_date")).scalar()
        newest = written.where(F.col("event_date") == last_day).agg(F.max("ts")).first()[0]
        if newest is None:
            return
        now = float(newest)
    else:
        now = run.clock()

    look_back = run.look_back or run.profile.look_back_seconds()
    window = read_since(
        spark, run.path("scored"), run.scored_schema, "ts",
        now - max(look_back, run.profile.fast_scan.window_seconds),
    ).where(F.col("batch") <= batch)
    passed = window.where(F.col("pred") == 0)
    with Staging(spark) as staging:
        found = d.run_rules(passed, run.profile, now, look_back, run.max_rows, staging).unionByName(
            d.detect_fast_scan(passed, run.profile.fast_scan)
        )
        append_batch(found, run.path("rule_alerts"), batch, "ts_generated")

    # Each alert is merged in the batch that raised it.
    fresh = F.col("batch") == batch
    previous = read_since(
        spark, run.path("merged_alerts"), MERGED_ALERT, "ts_merged", now - run.merge.cooldown_seconds
    ).where(F.col("batch") < batch)
    merged = a.merge_alerts(
        run.table(spark, "scored").where(fresh & (F.col("pred") == 1)).drop("event_date", "batch"),
        run.table(spark, "rule_alerts").where(fresh).drop("event_date", "batch"),
        now, run.merge, previous,
    )
    append_batch(merged, run.path("merged_alerts"), batch, "ts_merged")

    store = BanState(spark, run.path("ban_state"))
    state = store.load(before=batch)
    decisions = response.ban_decisions(
        run.table(spark, "merged_alerts").where(fresh), state, now, run.ban,
        response.whitelist(spark, run.allowed),
    )
    append_batch(decisions, run.path("bans"), batch, "added_ts")
    decided = run.table(spark, "bans").where(fresh)
    store.save(response.updated_state(state, decided, expired=now - run.ban.cooldown_seconds), batch)


def start_live(
    run: LiveRun, flows: DataFrame, trigger: dict | None = None
) -> StreamingQuery:
    """Start the live loop over a stream of flows.

    ``trigger`` is passed on, for example ``{"processingTime": "2 seconds"}``; the default
    works off everything that is there and stops.
    """
    return (
        flows.writeStream.option("checkpointLocation", run.path("checkpoint"))
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(lambda batch, number: process_batch(run, batch, number))
        .start()
    )


def with_watermark(flows: DataFrame, delay: str) -> DataFrame:
    """Flows with ``event_time`` and a lateness bound on it."""
    return flows.withColumn("event_time", epoch_to_timestamp("ts")).withWatermark("event_time", delay)


def victim_windows(flows: DataFrame, seconds: int) -> DataFrame:
    """Running statistics per target and tumbling window of a watermarked stream.

    Streams have no exact distinct count; the number of sources is an estimate within 2 %.
    """
    return (
        flows.groupBy(F.window("event_time", f"{seconds} seconds").alias("w"), "resp_h")
        .agg(
            F.count("*").alias("n"),
            F.sum("orig_pkts").alias("orig_pkts"),
            F.approx_count_distinct("orig_h", 0.02).alias("sources"),
        )
        .select(F.unix_seconds(F.col("w.start")).alias("window_start"), "resp_h", "n", "orig_pkts", "sources")
    )


def first_within_watermark(alerts: DataFrame) -> DataFrame:
    """Event-time cooldown on a stream: repeats of a type, attacker and target within the
    watermark delay are dropped. Missing parts of the key count as equal.

    An alert without any of the three has no identity to repeat and always passes. A repeat after
    the delay passes once the watermark has moved beyond the first alert's time plus the delay.
    """
    identified = F.coalesce(*a.COOLDOWN_KEY).isNotNull()
    first = alerts.where(identified).dropDuplicatesWithinWatermark(list(a.COOLDOWN_KEY))
    return first.unionByName(alerts.where(~identified))


def write_updates(stream: DataFrame, folder: str, trigger: dict | None = None) -> StreamingQuery:
    """Write every batch of updated rows under its number."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def latest_updates(spark: SparkSession, folder: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The last written row per key."""
    full = T.StructType([*schema.fields, BATCH_FIELD])
    rows = spark.read.schema(full).option("basePath", f"{folder}/rows").parquet(f"{folder}/rows")
    values = [f.name for f in schema.fields if f.name not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return last.select(*keys, "last.*")


BATCH_FIELD = T.StructField("batch", T.LongType())
