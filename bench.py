"""Time the headline queries and print one line of JSON.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query is run
twice to a sink that keeps nothing; the second time counts, so that a query is
not charged for starting the engine. The change logs are inputs and are
written before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    # Gold: readings, prices and investments to the marts.
    "monthly_consumption",
    "subsidy_entitlement",
    "investment_compliance",
    "compliance_summary",
    "compliance_report",
    "build_marts",
    "dq_gate",
    "dq_source_constraints",
    # Silver: decode and version.
    "cdc_decode_changes",
    "cdc_op_breakdown",
    "scd2_history",
    "scd2_current",
    "scd2_summary",
    "scd2_redelivered",
    "scd2_as_of",
    "asof_join",
    "compliance_from_logs",
    "reinvestment_matching",
    "interval_join",
    "bitemporal_join",
    # Bronze: streams.
    "stream_append_sink",
    "stream_exactly_once",
    "topic_relay",
    "stream_decoded_changes",
    "stream_duplicate_guard",
    # Prices and publishing.
    "price_series_source",
    "complete_days_only",
    "publish_full_refresh",
    # Text and retrieval.
    "html_to_text",
    "extract_between_anchors",
    "chunk_metadata",
    "knn_cosine",
    "knn_approx",
    "faithfulness_gate",
    "context_assembly",
)


def main() -> None:
    from registry import QUERIES
    from registry import inputs as I
    from registry import streams
    from strandline.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for build in (I.facilities, I.meter_log, I.investment_log, I.facility_log):
        build(spark, sf_dir)
    I.meter_log(spark, sf_dir, redelivered=True)
    I.written(spark, sf_dir, "event-log", "events", streams.build_event_log)

    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
