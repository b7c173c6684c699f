"""Host-grouped folds and sample weights for training."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowvigil.functions.coercion import strip, text_or
from flowvigil.operators.ordering import with_row_number
from flowvigil.staging import Staging

def host_rates(flows: DataFrame) -> DataFrame:
    """Rows, attack rows and attack rate per source host; a missing host is 'unknown'."""
    attack = (F.lower("label") == "attack").cast("bigint")
    return flows.groupBy(text_or("orig_h", "unknown").alias("orig_h")).agg(
        F.sum(F.coalesce(attack, F.lit(0))).alias("pos"),
        F.count("*").alias("n"),
    ).withColumn("rate", F.col("pos") / F.col("n"))


def attack_rate(hosts: DataFrame) -> DataFrame:
    """One row: the attack rate over all hosts."""
    return hosts.agg((F.sum("pos") / F.sum("n")).alias("rate"))


def serpentine_folds(hosts: DataFrame, k: int, staging: Staging) -> DataFrame:
    """Deal the hosts, ordered by attack rate and size, forth and back over ``k`` folds.

    Every run of 2k neighbours puts two hosts into each fold, which balances rate and size.
    """
    order = [F.desc("rate"), F.desc("n"), F.asc("orig_h")]
    dealt = with_row_number(hosts, order, staging, "position")
    place = (F.col("position") - 1) % (2 * k)
    return dealt.withColumn(
        "fold", F.when(place < k, place).otherwise(2 * k - 1 - place).cast("int")
    )


def with_fold(rows: DataFrame, folds: DataFrame) -> DataFrame:
    """Rows with the fold of their source host."""
    keyed = folds.select(F.col("orig_h").alias("_host"), "fold")
    return rows.join(keyed, text_or("orig_h", "unknown") == F.col("_host")).drop("_host")


def fold_split(rows: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Training rows and validation rows of one fold."""
    return rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)


def type_weights(rows: DataFrame, cap: float = 3.0) -> DataFrame:
    """Weight per attack type: the median type count over its own count, at most ``cap``."""
    kind = F.lower(strip(F.coalesce("attack_type", F.lit("none"))))
    counts = (
        rows.where(F.lower("label") == "attack")
        .groupBy(kind.alias("attack_type")).agg(F.count("*").alias("n"))
    )
    median = counts.agg(F.median("n")).scalar()
    return counts.withColumn("type_weight", F.least(F.lit(float(cap)), median / F.greatest("n", F.lit(1))))


def with_type_weight(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Rows with their type weight; normal rows weigh 1. Pass staged ``weights``.

    Only attack rows look at the weights, so normal rows do not meet on one key.
    """
    kind = F.lower(strip(F.coalesce("attack_type", F.lit("none"))))
    attack = F.coalesce(F.lower("label") == "attack", F.lit(False))
    keyed = weights.select(F.col("attack_type").alias("_type"), "type_weight")
    weighted = rows.where(attack).join(keyed, kind == F.col("_type"), "left").drop("_type")
    plain = rows.where(~attack).withColumn("type_weight", F.lit(1.0))
    return weighted.unionByName(plain)


def class_weights(rows: DataFrame, label: str = "y_bin") -> DataFrame:
    """Balancing weight per class: all rows over twice the rows of the class."""
    per_class = rows.groupBy(label).agg(F.count("*").alias("n"))
    total = per_class.agg(F.sum("n")).scalar()
    return per_class.withColumn("class_weight", total / (2.0 * F.col("n")))
