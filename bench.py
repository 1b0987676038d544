"""Wall time of the headline queries: one JSON line, warm, median of ``BENCH_RUNS`` runs.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]``. Every run covers the
whole query, jobs it starts while being built included, and writes all result rows to a no-op sink.
"""

import json
import os
import statistics
import sys
import time

from tickloom.plans import QUERIES
from tickloom.session import builder

HEADLINE = [
    "ohlc_bars_2m",
    "ohlc_bars_1h",
    "market_open",
    "market_session_feed",
    "clean_bars",
    "latest_bar_per_symbol",
    "updates_only",
    "relative_returns",
    "stride_sample",
    "box_summary",
    "series_unpivot",
    "bars_to_json_messages",
    "message_to_bar",
    "symbol_details_defaults",
    "html_profile",
    "html_nth_fields",
    "sink_csv_by_symbol",
    "stream_bars_ingest",
    "ols_per_symbol",
    "predict_prices",
    "predict_prices_per_symbol",
    "predict_next_close",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        builder(
            "bench",
            **{
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
                "spark.sql.shuffle.partitions": cpus,
                "spark.driver.memory": "8g",
            },
        )
        .master(f"local[{cpus}]")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    total = round(sum(seconds.values()), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
