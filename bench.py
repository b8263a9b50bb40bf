"""Benchmark: run the headline reports (R1-R26) at $BENCH_SF_DIR on local[$BENCH_CPUS].

BENCH_ALL=1 also times the stand-alone operator queries.

Each query is executed to completion with the ``noop`` sink (the full plan
runs, nothing is collected to the driver), ``BENCH_REPEAT`` times; the
median is reported. Prints ONE JSON line:
{"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from marketlens.registry import REPORTS, queries  # noqa: E402
from marketlens.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [p for p in os.environ.get("BENCH_ONLY", "").split(",") if p]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    todo = queries() if os.environ.get("BENCH_ALL") == "1" else REPORTS
    for name, fn in todo.items():
        if only and not any(p in name for p in only):
            continue
        runs = []
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
        except Exception as exc:  # noqa: BLE001 - one failing query must not lose the others
            errors[name] = str(exc).splitlines()[0][:300]
            continue
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "config": {"master": f"local[{cpus}]", "shuffle_partitions": cpus * 2, "repeat": repeat,
                   "sink": "noop"},
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
