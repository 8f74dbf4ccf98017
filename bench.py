"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))

HEADLINES = [
    "kept_by_source",
    "recipe_en_wiki",
    "recipe_web_crawl",
    "recipe_web_crawl_strict",
    "recipe_subset_exclusion",
    "recipe_code",
    "url_tld_filter",
    "keyword_count",
    "keyword_count_many",
    "compression_ratio",
    "extract_japanese",
    "strip_footnotes",
    "strip_parens",
    "tokenize_subword",
    "tokenize_vocab",
    "tokens_per_shard",
    "corpus_totals",
    "holdout_per_shard",
    "token_budget_sample",
    "hash_ids",
    "split_by_ids",
    "split_by_ids_shuffled",
    "filter_quality",
    "recipe_quality",
    "jsonl_roundtrip",
    "filtered_chunks",
    "stream_recipe",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small run, so that the first query does not pay for starting the workers.
    QUERIES["compression_ratio"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
