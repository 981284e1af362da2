"""Time the headline queries; prints one JSON line.

Each query is planned and run twice through a no-op sink; the second time counts,
so the first pays for class loading and code generation.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import QUERIES, Tables  # noqa: E402
from upswell.session import build_session  # noqa: E402

HEADLINE = [
    "load_articles", "filter_relevant_news", "validate_claims", "group_claims", "content_fingerprint", "canonical_urls",
    "extract_page_facts", "extract_amounts", "classify_funding_text", "classify_source_tiers", "dedupe_events",
    "event_rollup", "funding_rollup", "peer_percentile", "independent_sources", "resolve_entities", "upsert_by_key",
    "score_companies", "rank_regions", "enrich_companies", "build_event_facts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name].run(Tables(spark, sf_dir)).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
