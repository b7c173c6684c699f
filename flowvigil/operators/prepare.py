"""From raw flow logs to one labelled, normalized, de-duplicated flow table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from flowvigil.config import SERVICE_DEFAULT, SERVICE_MAP
from flowvigil.functions import categories
from flowvigil.functions.coercion import epoch_to_timestamp, number_or_null

# Endpoint names of the flow log and the names used here.
ENDPOINT_ALIASES = {
    "id.orig_h": "orig_h",
    "id.orig_p": "orig_p",
    "id.resp_h": "resp_h",
    "id.resp_p": "resp_p",
}

# Columns that hold numbers.
NUMBER_COLUMNS = (
    "duration", "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts", "missed_bytes",
    "orig_ip_bytes", "resp_ip_bytes", "orig_p", "resp_p",
)
_WHOLE = {"orig_p": "int", "resp_p": "int"}

TUNNEL = "tunnel_ayiya"
TUNNEL_POLICIES = ("keep", "drop", "mark-rare")


def rename_endpoints(df: DataFrame) -> DataFrame:
    """Dotted endpoint names to plain ones; a plain column already there is kept."""
    return df.withColumnsRenamed(
        {
            dotted: plain
            for dotted, plain in ENDPOINT_ALIASES.items()
            if dotted in df.columns and plain not in df.columns
        }
    )


def coerce_numbers(df: DataFrame) -> DataFrame:
    """Every known numeric column as a number, NULL where the text is not one."""
    return df.withColumns(
        {
            c: number_or_null(c).try_cast(_WHOLE.get(c, "double"))
            for c in NUMBER_COLUMNS
            if c in df.columns
        }
    )


def with_event_time(df: DataFrame) -> DataFrame:
    time = epoch_to_timestamp("ts") if "ts" in df.columns else F.lit(None).cast("timestamp")
    return df.withColumn("event_time", time)


def ensure_columns(df: DataFrame, schema: T.StructType, fill: object = None) -> DataFrame:
    """Add the columns of ``schema`` that are missing, holding ``fill``."""
    return df.withColumns(
        {f.name: F.lit(fill).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    )


def with_label(df: DataFrame, label: str) -> DataFrame:
    """Set the label of a single-label table and normalize its attack type."""
    label = label.lower()
    kind = F.col("attack_type") if "attack_type" in df.columns else F.lit(None)
    return df.withColumns(
        {"label": F.lit(label), "attack_type": categories.attack_type_norm(kind, label)}
    )


def with_service_norm(
    df: DataFrame, mapping: dict[str, str] = SERVICE_MAP, default: str = SERVICE_DEFAULT
) -> DataFrame:
    service = F.col("service") if "service" in df.columns else F.lit(None).cast("string")
    return df.withColumn("service_norm", categories.service_norm(service, mapping, default))


def with_direction(df: DataFrame) -> DataFrame:
    df = ensure_columns(df, T.StructType([T.StructField(c, T.StringType()) for c in ("orig_h", "resp_h")]))
    return df.withColumn("flow_dir", categories.flow_direction("orig_h", "resp_h"))


def normalize(df: DataFrame, label: str, mapping=SERVICE_MAP, default=SERVICE_DEFAULT) -> DataFrame:
    """All per-row normalization of one labelled log."""
    typed = with_event_time(coerce_numbers(rename_endpoints(df)))
    return with_direction(with_service_norm(with_label(typed, label), mapping, default))


def union_labelled(normal: DataFrame, attack: DataFrame) -> DataFrame:
    """Both logs under the sorted union of their columns."""
    columns = sorted({*normal.columns, *attack.columns})
    return normal.unionByName(attack, allowMissingColumns=True).select(
        *[F.col(f"`{c}`") for c in columns]
    )


def drop_external(df: DataFrame) -> DataFrame:
    """Drop flows between two external hosts."""
    return df.where(F.col("flow_dir") != "e↔e")


def apply_tunnel_policy(df: DataFrame, policy: str = "keep") -> DataFrame:
    if policy not in TUNNEL_POLICIES:
        raise ValueError(f"tunnel policy must be one of {TUNNEL_POLICIES}")
    tunnel = F.col("service_norm") == TUNNEL
    if policy == "drop":
        return df.where(~tunnel)
    if policy == "mark-rare":
        return df.withColumn("rare_service", tunnel.cast("int"))
    return df


def _first_seen(df: DataFrame) -> list[Column]:
    """Normal rows come before attack rows, then time, then the remaining columns."""
    order = [F.when(F.col("label") == "normal", 0).otherwise(1)] if "label" in df.columns else []
    leading = [c for c in ("ts",) if c in df.columns]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in leading]
    return [*order, *[F.col(c) for c in leading], *rest]


def dedupe(df: DataFrame) -> DataFrame:
    """Keep the first row per ``uid``; without ``uid`` per connection key, else per whole row.

    Missing keys count as equal. The row-number filter is applied on each partition before
    the shuffle, so a key that holds most rows still sends one row per partition.
    """
    fallback = ("orig_h", "resp_h", "orig_p", "resp_p", "proto", "event_time")
    keys = ["uid"] if "uid" in df.columns else [c for c in fallback if c in df.columns]
    if not keys:
        return df.dropDuplicates()
    window = Window.partitionBy(*keys).orderBy(*_first_seen(df))
    ranked = df.withColumn("_seen", F.row_number().over(window))
    return ranked.where(F.col("_seen") == 1).drop("_seen")


def prepare_labelled(
    normal: DataFrame,
    attack: DataFrame,
    mapping: dict[str, str] = SERVICE_MAP,
    default: str = SERVICE_DEFAULT,
    drop_external_external: bool = False,
    tunnel_policy: str = "keep",
) -> DataFrame:
    """Labelled training table from a normal and an attack log."""
    flows = union_labelled(
        normalize(normal, "normal", mapping, default), normalize(attack, "attack", mapping, default)
    )
    if drop_external_external:
        flows = drop_external(flows)
    return dedupe(apply_tunnel_policy(flows, tunnel_policy))
