"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the cores.
Each query is run to completion without keeping its rows, once to warm up and then timed
BENCH_RUNS (default 3) times; the middle time counts. The bulk figures write and read real Parquet
tables of 10,000,000 rows.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
BULK_ROWS = int(os.environ.get("BENCH_BULK_ROWS", "10000000"))

HEADLINE = (
    "q01_category_films_join",
    "q02_store_revenue_cte",
    "q03_busiest_actors_cte",
    "q04_genres_per_year_join",
    "q05_top_staff_cte",
    "q06_most_rented_cte",
    "q07_years_since_last_film_join",
    "q08_largest_year_gap_cte",
    "q09_category_revenue_quarter",
    "q10_popular_films_by_country",
    "q11_rentals_in_stock_by_title",
    "q13_stock_status",
    "q15_copy_holders",
    "q16_customer_balances",
    "q18_rewards_report",
    "q19_latest_quarter_visits",
    "q22_load_films_if_absent",
    "q26_rename_regular_customer",
    "q27_delete_history_payment",
    "q29_pay_by_title",
    "q33_visible_payment",
    "q37_museum_constraints",
    "t6_term_positions",
)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    from tallyhouse import catalog
    from tallyhouse.plans import bulk
    from tallyhouse.session import build_session
    from tallyhouse.sources import sinks

    with tempfile.TemporaryDirectory(prefix="tallyhouse-bench-") as scratch:
        spark = build_session(CPUS, shuffle_partitions=int(CPUS))
        if not spark.conf.get("spark.checkpoint.dir", None):
            spark.sparkContext.setCheckpointDir(scratch)
        runs: dict[str, list[float]] = {}

        def timed(name: str, action):
            begun = time.perf_counter()
            result = action()
            runs.setdefault(name, []).append(round(time.perf_counter() - begun, 3))
            return result

        for name in HEADLINE:
            run(catalog.QUERIES[name](spark, FOLDER))
            for _ in range(RUNS):
                timed(name, lambda: run(catalog.QUERIES[name](spark, FOLDER)))

        series = bulk.labelled_series(spark, BULK_ROWS)
        table = timed("q30_bulk_create", lambda: sinks.create_table_as(series, "series"))
        kept = bulk.drop_multiples(table).table
        timed("q31_bulk_delete", lambda: sinks.create_table_as(kept, "series-kept"))
        timed("w09_bulk_truncate", lambda: sinks.create_table_as(table.limit(0), "series-empty"))
        spark.stop()

    times = {name: sorted(taken)[len(taken) // 2] for name, taken in runs.items()}
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
