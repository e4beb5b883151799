"""Time the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores."""

import json
import os
import time

from emberline.plans.queries import registered
from emberline.session import build_session

HEADLINE = (
    "post_features",
    "merged_posts",
    "recent_posts",
    "viral_scores",
    "archetypes_top40",
    "tfidf_terms",
    "tfidf_vectors",
    "similarity_scores",
    "predictions",
    "label_distribution",
    "prediction_totals",
    "subreddit_summary",
    "listing_dedup_first",
    "bronze_roundtrip",
    "predictions_roundtrip",
    "sql_label_counts",
    "stream_silver",
    "stream_counters",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's code paths on the smallest query; no query result is kept between runs.
    registered()["date_range"](spark, sf_dir).collect()
    spent = {}
    for name in HEADLINE:
        started = time.perf_counter()
        registered()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - started, 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(spent.values()), 3),
        "unit": "sec",
        "queries": spent,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
