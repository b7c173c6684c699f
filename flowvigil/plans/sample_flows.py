"""Flow records derived from the ``events`` table.

The same SELECT runs on Spark and on DuckDB; only two expressions are spelled differently.
"""

from pyspark.sql import DataFrame, SparkSession

_SELECT = """
SELECT concat('C', CAST(event_id AS STRING)) AS uid, ts,
  concat(CASE WHEN user_id % 5 = 0 THEN '45.33.' ELSE '10.0.' END,
         CAST(CAST(floor(user_id / 250) AS BIGINT) AS STRING), '.',
         CAST(user_id % 250 + 1 AS STRING)) AS orig_h,
  CAST(49152 + event_id % 16384 AS INT) AS orig_p,
  CASE WHEN k % 4 = 0 THEN concat('8.8.4.', CAST(k % 20 AS STRING))
       ELSE concat('192.168.1.', CAST(k % 20 AS STRING)) END AS resp_h,
  CASE CAST((cents + k) % 10 AS INT) WHEN 0 THEN 22 WHEN 1 THEN 53 WHEN 2 THEN 80 WHEN 3 THEN 443
       WHEN 4 THEN 3389 WHEN 5 THEN 8080 WHEN 6 THEN 23 WHEN 7 THEN 1900 WHEN 8 THEN 123
       ELSE 5353 END AS resp_p,
  CASE WHEN cents % 10 < 6 THEN 'tcp' WHEN cents % 10 < 9 THEN 'udp' ELSE 'icmp' END AS proto,
  CASE WHEN k % 6 = 0 THEN 'quic,ssl' WHEN k % 6 = 1 THEN 'ssl' WHEN k % 6 = 2 THEN 'ssl,http'
       WHEN k % 6 = 3 THEN 'mdns' WHEN k % 6 = 4 THEN '-' ELSE NULL END AS service,
  CASE event_type WHEN 'click' THEN 'SF' WHEN 'view' THEN 'S1' WHEN 'purchase' THEN 'S0'
       WHEN 'signup' THEN 'OTH' ELSE 'REJ' END AS conn_state,
  CASE event_type WHEN 'click' THEN 'ShADadFf' WHEN 'view' THEN 'ShAD' WHEN 'purchase' THEN 'S'
       WHEN 'signup' THEN 'D' ELSE 'Sr' END AS history,
  value / 10.0 AS duration, cents AS orig_bytes, cents * (k % 13) AS resp_bytes,
  CAST(k + 1 AS BIGINT) AS orig_pkts, CAST(k % 7 AS BIGINT) AS resp_pkts,
  CAST(0 AS BIGINT) AS missed_bytes,
  CASE WHEN event_type IN ('purchase','error') AND k >= 30 THEN 'attack' ELSE 'normal' END AS label,
  CASE WHEN event_type = 'purchase' AND k >= 30 THEN 'ddos'
       WHEN event_type = 'error' AND k >= 30 THEN 'port_scan' ELSE 'none' END AS attack_type,
  CAST((cents * 7 + k) % 1000 AS DOUBLE) / 1000.0 AS p_raw
FROM (
  SELECT event_id, user_id, event_type, value, {epoch} AS ts,
         CAST(round(value * 100) AS BIGINT) AS cents, CAST({k} AS INT) AS k
  FROM {source}
) AS e
"""

SPARK_SELECT = _SELECT.format(
    epoch="unix_micros(CAST(ts AS TIMESTAMP)) / 1000000D",
    k="get_json_object(props, '$.k')",
    source="{events}",
)

# Common table expression that DuckDB queries start with.
DUCKDB_FLOWS = "flows AS ({})".format(
    _SELECT.format(epoch="epoch(ts)", k="json_extract_string(props, '$.k')", source="events")
)


#: Events that a task reads, about. They are packed tightly, so a split of a file can hold many times more.
ROWS_A_TASK = 200_000


def load_flows(spark: SparkSession, folder: str) -> DataFrame:
    # Event times carry no zone; they are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{folder}/events.parquet")
    return flows_of(spread(events))


def spread(events: DataFrame) -> DataFrame:
    """The events in a task for each ``ROWS_A_TASK`` rows, where their files give fewer tasks."""
    tasks = -(-events.count() // ROWS_A_TASK)
    if tasks <= max(1, events.rdd.getNumPartitions()):
        return events
    # By values, as dealing in turn sorts each split first.
    return events.repartition(tasks, "event_id", "ts", "user_id")


def flows_of(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(SPARK_SELECT, events=events)
