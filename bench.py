"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` pick data and cores; names on the command
line pick queries, ``all`` means every registered one.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import QUERIES  # noqa: E402
from mediasignal.session import build_session  # noqa: E402

HEADLINE = [
    "agg_country_month", "agg_drop_counts", "agg_dedupe_url", "agg_label_dist", "agg_request_counts",
    "gen_grid", "gen_request_url", "io_read_projected", "limit_per_window", "stage_collect", "sc_themes",
    "join_pages", "nlp_extract", "nlp_language", "nlp_language_table", "nlp_translate_body", "nlp_sentiment",
    "nlp_sentiment_table", "nlp_entities", "nlp_entities_known", "nlp_body_choice", "enrich_full",
    "enrich_full_table", "io_incremental", "stage_run", "nlp_sentiment_ml", "join_enriched_left", "nlp_entities_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    names = list(QUERIES) if names == ["all"] else names
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # Start the workers and load the classes before the clock runs.
    QUERIES["agg_label_dist"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").split("/sf")[-1]}))


if __name__ == "__main__":
    main()
