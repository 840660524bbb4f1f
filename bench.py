"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

    python bench.py            # the headline queries
    python bench.py a b c      # only these
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from wordloom.plans.catalog import QUERIES  # noqa: E402
from wordloom.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "doc_index", "tokenize_unique", "postings", "keyword_dictionary", "stem_vocabulary",
    "classify_keywords", "match_like", "match_regexp", "match_stemmed", "match_like_batch",
    "match_phrases", "match_fulltext", "fulltext_relevance", "search", "search_regexp",
    "search_fulltext", "search_stored", "search_run", "search_batch", "excerpts", "found_rows", "filter_section", "soundalikes",
    "closest_alternative", "suggest_topk", "log_groups", "log_stats", "log_page",
    "upsert_entries", "orphan_keywords", "stream_index_changes", "stream_log_groups",
]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = local_session(CPUS, int(CPUS))
    run(spark, "log_groups")  # start the JVM's and Spark's own machinery
    seconds = {}
    for name in names:
        seconds[name] = round(run(spark, name), 3)
        print(f"{name:24s} {seconds[name]:8.2f}", file=sys.stderr, flush=True)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
