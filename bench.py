"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs into Spark's ``noop`` sink (full execution, no collect),
once to warm up and then three times; the median wall time is reported.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ioclake.plans.catalog import QUERIES  # noqa: E402
from ioclake.plans.flagship import flagship  # noqa: E402
from ioclake.session import build_session  # noqa: E402
from ioclake.sources.tables import SCAN_PARTITIONS  # noqa: E402

HEADLINE = [
    "page_text", "url_normalize", "links_first_n", "dedup_by_url", "validate_articles",
    "doc_tokens", "sentence_split", "chunk_tokens", "iocs_patterns", "iocs_url_email",
    "gazetteer_mentions", "actors_merged", "actor_targets", "actor_related_iocs", "iocs_all",
    "response_parse", "response_attempts", "article_combine", "report_summary",
    "report_landscape", "rejects", "stage_counts", "report_json", "articles_enriched",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={SCAN_PARTITIONS: str(int(cpus) * 2)})
    funcs = {"flagship": flagship, **{n: QUERIES[n] for n in HEADLINE}}
    times = {}
    for name, fn in funcs.items():
        run(fn(spark, sf))  # warm-up: codegen, file listing
        laps = []
        for _ in range(reps):
            t = time.perf_counter()
            run(fn(spark, sf))
            laps.append(time.perf_counter() - t)
        times[name] = round(statistics.median(laps), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
                      "cpus": int(cpus), "reps": reps}))


if __name__ == "__main__":
    main()
