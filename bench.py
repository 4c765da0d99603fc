"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Each query is run
to completion into Spark's noop sink, after one small query that starts the session; quick ones three times.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).parent))

from pyspark.sql import SparkSession

from ledgerline.session import build_session
from registered.queries import REGISTERED

HEADLINE = [
    "clean_establishments", "clean_announcements", "clean_markets", "extract_siren",
    "scd2_establishments", "scd2_links", "scd2_markets_nullsafe", "scd2_replay",
    "exact_match", "unresolved_completion", "gamma_histogram", "fuzzy_score_fixed_params",
    "cascade_fixed_params", "cascade", "validate_markets", "unresolved_composition",
    "serving_join", "won_then_bankrupt",
]


#: Queries quicker than this (seconds) are run three times, and their median counts.
REPEATED_BELOW = 8.0


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        conf={
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTERED["dq_not_null"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        runs = [timed(spark, name, sf_dir)]
        if runs[0] < REPEATED_BELOW:
            runs += [timed(spark, name, sf_dir) for _ in range(2)]
        seconds[name] = round(median(runs), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, [round(r, 3) for r in runs], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, wall time",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
            }
        )
    )


if __name__ == "__main__":
    main()
