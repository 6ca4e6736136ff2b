"""Benchmark: the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each headline query: one warm-up run, then the median of ``$BENCH_RUNS``
(default 5) runs, the result written to the ``noop`` sink (the whole plan
runs, nothing is collected). With ``BENCH_ALL=1`` (default) every other
registered query is also timed once after a warm-up. Landed fixture files are
made during warm-up and reused. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from prodlake.plans import catalog  # noqa: E402
from prodlake.session import build_session, shared_dir  # noqa: E402

HEADLINE = ["oil_sum_between", "carrier_year_sums", "search", "oil_pivot", "apply_updates", "copy_lake_to_table"]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    run_all = os.environ.get("BENCH_ALL", "1") == "1"
    spark = build_session(
        f"local[{cpus}]",
        app_name="prodlake-bench",
        shuffle_partitions=max(2 * cpus, 8),
        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "8g")},
    )
    # the shared folder comes from spark.checkpoint.dir; only a local run
    # without it gets a fresh folder of its own
    shared_dir(spark)
    qs = catalog.queries()
    timings: dict[str, float] = {}
    others: dict[str, float] = {}
    errors: dict[str, str] = {}

    def timed(name: str, n: int, into: dict[str, float]) -> None:
        # one failing query is reported, and does not cost the other timings
        try:
            run_once(spark, qs[name], sf_dir)
            into[name] = round(statistics.median(run_once(spark, qs[name], sf_dir) for _ in range(n)), 3)
        except Exception as e:  # noqa: BLE001
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"

    for name in HEADLINE:
        timed(name, runs, timings)
    if run_all:
        for name in sorted(set(qs) - set(HEADLINE)):
            timed(name, 1, others)
    sf = Path(sf_dir).name.removeprefix("sf")
    out = {
        "metric": "headline_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {**timings, **others},
        "headline": HEADLINE,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
