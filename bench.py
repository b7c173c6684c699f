"""Wall time of the headline queries; prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from flowvigil.plans import catalogue  # noqa: E402
from flowvigil.session import build_session  # noqa: E402

HEADLINE = (
    "service_norm", "flow_direction", "dedupe_uid", "profile_topvalues", "winsorize",
    "flow_rollup", "stat_src_short", "stat_victim_long", "port_scan", "bruteforce", "icmp_flood",
    "dns_flood", "ddos", "rejscan_fast", "rules_all", "merge_alerts", "cooldown", "ban_candidates",
    "alerts_browse", "host_folds", "pr_curve", "pick_threshold", "isotonic", "stream_tumbling",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue.queries()
    # The first query pays for class loading; it is run once unmeasured.
    queries["port_scan"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
