"""Run registered queries against DuckDB: python tests/check_queries.py FOLDER [name ...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from compare import differences, duckdb_over  # noqa: E402
from flowvigil.plans import catalogue  # noqa: E402
from flowvigil.session import build_session  # noqa: E402


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "check", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_over(folder)
    oracle, bad = catalogue.oracle_sql(), 0
    for name, query in catalogue.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, folder).toPandas()
        except Exception as error:  # noqa: BLE001
            print(f"{name:24s} FAILED {type(error).__name__}: {str(error)[:1500]}", flush=True)
            bad += 1
            continue
        seconds = time.time() - start
        if name not in oracle:
            print(f"{name:24s} rows {len(frame):7d} {seconds:6.2f}s (no sql)", flush=True)
            continue
        try:
            problem = differences(frame, con.execute(oracle[name]).df())
        except Exception as error:  # noqa: BLE001
            problem = f"sql error {error}"
        bad += bool(problem)
        print(f"{name:24s} rows {len(frame):7d} {seconds:6.2f}s {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
