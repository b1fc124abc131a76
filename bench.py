"""Time the index builds and every registered query; prints one JSON line.

BENCH_SF_DIR is the input folder, BENCH_CPUS the number of local cores, BENCH_RUNS how
often each build and query runs (the best run counts). Queries reopen the stored
indexes, as searches do in use; what an index costs is shown by its build.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registered import inputs  # noqa: E402
from registered.queries import QUERIES  # noqa: E402

BUILDS = {
    "build_faq_index": inputs.faq_index,
    "build_chunks": inputs.chunks,
    "build_chunk_index": inputs.chunk_index,
    "build_label_ivf": inputs.label_ivf,
    "build_kmeans_ivf": inputs.kmeans_ivf,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("seekframe-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    if not sys.argv[1:]:
        timed = {name: [] for name in BUILDS}
        for _ in range(runs):
            inputs.forget()
            for name, build in BUILDS.items():
                start = time.perf_counter()
                build(spark, sf_dir)
                timed[name].append(time.perf_counter() - start)
        seconds = {name: round(min(t), 3) for name, t in timed.items()}
    for name in names:
        timed = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timed.append(time.perf_counter() - start)
        seconds[name] = round(min(timed), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of index builds and registered queries",
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
