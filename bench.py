"""Headline queries on one machine; prints one JSON line."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textsignal.plans import QUERIES  # noqa: E402
from textsignal.session import build_session  # noqa: E402

HEADLINE = [
    "b16_full_clean",
    "b22_fix_text",
    "c01_lexicon",
    "c11_feature_row",
    "d05_tfidf_unigram",
    "d06_tfidf_bigram",
    "d07_tfidf_char",
    "d10_top_terms",
    "e03_mean_pool",
    "e11_knn_15",
    "f01_folds",
    "g03_multinomial_nb",
    "g06_knn_classifier",
    "g10_metric_record",
    "h03_report",
    "h14_temperature_search",
    "h17_bootstrap",
    "i04_weighted_vote",
    "i07_weight_search",
    "j02_length_summary",
    "j07_near_duplicates",
    "j10_normalised_overlap",
    "j11_shift",
    "k03_route",
    "k05_tau_sweep",
    "l04_session_stats",
    "l06_stream_session_stats",
    "l07_stream_windows",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    run(spark, "b16_full_clean", sf_dir)  # starts the Python workers and warms the JVM up
    seconds = {}
    for name in names:
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
