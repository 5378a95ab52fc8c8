"""Times the headline queries on local cores and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from workload.queries import run  # noqa: E402

HEADLINES = [
    "ttv",
    "tax_ttv",
    "client_commission",
    "cost_measures",
    "hotel_pay_measures",
    "transfer_pricing",
    "tp_eur_measures",
    "component_tax_sum",
    "semi_join_keys",
    "anti_join_not_exists",
    "destination_code",
    "direct_fields",
    "asof_rate",
    "fx_triangulate",
    "fx_convert",
    "measure_star_join",
    "sql_star_extract",
    "full_extract",
    "windowed_extract",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("staymart-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # The widest aggregation has 52 decimal sums of two buffer fields each.
        .config("spark.sql.codegen.maxFields", "300")
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    run("ttv", spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
