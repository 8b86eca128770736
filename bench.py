"""Times the headline queries and prints one JSON line.

Reads ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8). Every query is run to its last
row and column through the ``noop`` writer. Short queries run twice and count with the better time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from bazaarlens.plans import catalog
from bazaarlens.session import local_session

HEADLINE = (
    "clean_all",
    "cl_desc",
    "cl_name_documents",
    "pg_links",
    "pg_urls_a",
    "pg_fields_by_class",
    "pg_variants",
    "pg_stream",
    "ft_prepare",
    "ft_tfidf",
    "ft_idf",
    "ev_rmsle",
    "md_lr",
    "md_rf",
    "md_cv_lr",
)
SHORT = 20.0


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), memory="16g", app="bench")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        best = timed(spark, sf_dir, name)
        if best < SHORT:
            best = min(best, timed(spark, sf_dir, name))
        seconds[name] = round(best, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = os.path.basename(sf_dir).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
