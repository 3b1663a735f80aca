"""Time the registered queries and print one JSON line.

Settings: ``BENCH_SF_DIR`` (data folder), ``BENCH_CPUS`` (local cores),
``BENCH_RUNS`` (warm runs, the median counts), ``BENCH_QUERIES`` (comma list),
``BENCH_SHARED_DIR`` (folder of the intermediate tables).
Every run materialises the whole result. The stored star schemas, graph, word
indexes and vector cells are built once; building them is timed as ``build_*``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gaugeline.plans import adapt  # noqa: E402
from gaugeline.plans.catalogue import QUERIES  # noqa: E402
from gaugeline.session import build_session  # noqa: E402

BUILDS = {
    "build_order_star": adapt.order_star,
    "build_trade_star": adapt.trade_star,
    "build_trade_graph": adapt.trade_graph,
    "build_trade_lists": adapt.trade_lists,
    "build_document_index": adapt.document_index,
    "build_part_index": adapt.part_index,
    "build_vector_cells": adapt.vector_cells,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus), **{
            "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    for name, build in BUILDS.items():
        start = time.perf_counter()
        build(spark, sf_dir)
        times[name] = round(time.perf_counter() - start, 3)

    for name, query in QUERIES.items():
        if chosen and name not in chosen:
            continue
        spent = []
        for _ in range(runs + 1):  # the first run warms up and does not count
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - start)
        times[name] = round(statistics.median(spent[1:]), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)

    print(json.dumps({
        "metric": "total seconds over all queries, warm",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cores": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
