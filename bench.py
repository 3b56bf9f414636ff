"""Time the headline queries: prints one JSON line."""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from placetally.session import build_session  # noqa: E402

HEADLINE = (
    "state_county_words", "metro_words", "poi_nearby",
    "county_join", "nearest_metro", "poi_within",
    "word_extract_count", "word_rollup", "group_word_count", "page_words",
    "geohash_cells", "cell_reuse", "near_points",
)
# The faster of two rounds counts: the first one also pays for the start of the JVM.
ROUNDS = 2


def run(spark, sf_dir: str, name: str) -> None:
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="placetally-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for _ in range(ROUNDS):
        for name in HEADLINE:
            started = time.perf_counter()
            run(spark, sf_dir, name)
            elapsed = round(time.perf_counter() - started, 3)
            seconds[name] = min(elapsed, seconds.get(name, elapsed))
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
