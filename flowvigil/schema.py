"""Column layouts and fixed domains shared by every operator."""

from pyspark.sql import types as T

FLOW = T.StructType(
    [
        T.StructField("ts", T.DoubleType()),
        T.StructField("uid", T.StringType()),
        T.StructField("orig_h", T.StringType()),
        T.StructField("orig_p", T.IntegerType()),
        T.StructField("resp_h", T.StringType()),
        T.StructField("resp_p", T.IntegerType()),
        T.StructField("proto", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("conn_state", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("orig_bytes", T.DoubleType()),
        T.StructField("resp_bytes", T.DoubleType()),
        T.StructField("orig_pkts", T.LongType()),
        T.StructField("resp_pkts", T.LongType()),
        T.StructField("missed_bytes", T.LongType()),
    ]
)

# Columns a flow log may carry besides the fifteen above.
FLOW_OPTIONAL = T.StructType(
    [
        T.StructField("history", T.StringType()),
        T.StructField("orig_ip_bytes", T.LongType()),
        T.StructField("resp_ip_bytes", T.LongType()),
    ]
)

SCORE = T.StructType(
    [
        T.StructField("p_raw", T.DoubleType()),
        T.StructField("p_cal", T.DoubleType()),
        T.StructField("pred", T.IntegerType()),
        T.StructField("margin", T.DoubleType()),
    ]
)

SCORED_FLOW = T.StructType(FLOW.fields + SCORE.fields)

RULE_ALERT = T.StructType(
    [
        T.StructField("ts_generated", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("attacker_ip", T.StringType()),
        T.StructField("target_ip", T.StringType()),
        T.StructField("total", T.LongType()),
        T.StructField("uniq_src", T.LongType()),
        T.StructField("uniq_hosts", T.LongType()),
        T.StructField("uniq_ports", T.LongType()),
        T.StructField("uniq_pairs", T.LongType()),
        T.StructField("fail_ratio", T.DoubleType()),
        T.StructField("attempts", T.LongType()),
    ]
)

MERGED_ALERT = T.StructType(
    [
        T.StructField("ts", T.DoubleType()),
        T.StructField("uid", T.StringType()),
        T.StructField("orig_h", T.StringType()),
        T.StructField("orig_p", T.IntegerType()),
        T.StructField("resp_h", T.StringType()),
        T.StructField("resp_p", T.IntegerType()),
        T.StructField("proto", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("conn_state", T.StringType()),
        T.StructField("p_cal", T.DoubleType()),
        T.StructField("pred", T.IntegerType()),
        T.StructField("margin", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("attacker_ip", T.StringType()),
        T.StructField("target_ip", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("ts_merged", T.DoubleType()),
    ]
)

BAN_STATE = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("last_added_ts", T.DoubleType()),
    ]
)

BAN_DECISION = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("added_ts", T.DoubleType()),
        T.StructField("expires_ts", T.DoubleType()),
        T.StructField("set_name", T.StringType()),
    ]
)

# Connection states counted as failed and as successful. S1 is in both.
FAIL_STATES = ("S0", "S1", "SH", "REJ", "RSTO", "RSTR", "RSTOS0")
SUCCESS_STATES = ("SF", "S1", "ESTAB")

# The states a feature row may carry; anything else becomes UNK.
CONN_STATES = (
    "OTH", "REJ", "RSTO", "RSTOS0", "RSTR", "RSTRH",
    "S0", "S1", "S2", "S3", "SF", "SH", "SHR", "UNK",
)

# Severity order.
SEVERITIES = ("low", "med", "high")
