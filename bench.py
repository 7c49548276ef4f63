"""Benchmark: every registered query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query runs in full through the ``noop`` sink (all rows computed, none
collected). Batch queries are timed first, then the streaming ones; in each
phase one warm-up pass, then ``$BENCH_RUNS`` timed passes, and a query's time
is the median of its passes. Prints one JSON line. ``$BENCH_EVENT_LOG`` (a
folder) turns on Spark's event log for stage and task times.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.queries import QUERIES as BATCH  # noqa: E402
from strata.plans.drop_queries import DROP_QUERIES  # noqa: E402
from strata.plans.stream_queries import STREAM_QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")}
    if os.environ.get("BENCH_EVENT_LOG"):   # stage / task times for later study, no UI needed
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = build_session(f"local[{cpus}]", app="strata-bench", shuffle_partitions=int(cpus) * 2, conf=conf)
    QUERIES = {**BATCH, **DROP_QUERIES, **STREAM_QUERIES}

    def probe() -> float:
        """A fixed scan and aggregate: how fast the machine is just now."""
        t0 = time.perf_counter()
        lines = spark.read.parquet(os.path.join(root, "lineitem.parquet"))
        lines.groupBy("l_returnflag", "l_linestatus").sum("l_quantity", "l_extendedprice").collect()
        return time.perf_counter() - t0

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Batch queries first, then the streaming twins: finished streams leave
    # state-store upkeep behind that would otherwise slow the batch passes.
    med = {}
    phases = {}
    probes = [probe() for _ in range(3)][1:]
    for label, phase in (("batch", {**BATCH, **DROP_QUERIES}), ("stream", STREAM_QUERIES)):
        names = [q for q in phase if not only or q in only]
        for name in names:
            run(name)
        times = {name: [] for name in names}
        for _ in range(runs):
            probes.append(probe())
            for name in names:
                times[name].append(run(name))
        part = {name: round(statistics.median(ts), 3) for name, ts in times.items()}
        med.update(part)
        phases[label] = round(sum(part.values()), 3)
    sf = os.path.basename(os.path.normpath(root)).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(med.values()), 3),
                      "unit": "sec", "queries": med, "phases": phases, "sf": sf, "cpus": int(cpus),
                      "runs": runs, "probe": round(statistics.median(probes), 3),
                      "value_over_probe": round(sum(med.values()) / statistics.median(probes), 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
