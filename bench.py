"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Rendered stand-in inputs (CSV / statement text written from the driver
tables) are produced first and not timed; each query is then run once to
completion (``noop`` sink) and timed. Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma-separated subset, default all).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from fundlake.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8),
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 # small inputs: split files so every core gets a share
                                 "spark.sql.files.openCostInBytes": os.environ.get("BENCH_OPEN_COST", "1048576")})
    from fundlake.plans import fixtures as fx
    from fundlake.plans.catalog import QUERIES

    t0 = time.time()
    for render in (fx.customer_csv, fx.supplier_pipe, fx.nation_skips, fx.part_blanks, fx.documents_csv,
                   fx.orders_split, fx.orders_defects, fx.customer_dups, fx.lineitem_holdings,
                   fx.statements_text):
        render(spark, sf_dir)
    render_s = time.time() - t0

    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(QUERIES)
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    failed: dict[str, str] = {}
    for name in wanted:
        t = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t, 3)
        except Exception as e:  # keep measuring the rest
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
           "input_render_seconds": round(render_s, 3)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
