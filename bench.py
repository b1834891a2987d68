"""Time every registered query and print one JSON line.

Settings: BENCH_SF_DIR, BENCH_CPUS, and BENCH_ONLY (comma-separated query names).
A query's time covers its plan, its run (for a stream: the whole run over the
replayed lines) and reading every result row. Session start and one untimed
query on the smallest tables come first. The replay that the streaming queries
share is timed on its own, as ``replay``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from skyledger.queries import all_queries, shared_topic
from skyledger.session import build_session


def _seconds(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def _read_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = build_session(
        "skyledger-bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__log__level="ERROR",
    )
    queries = {n: q for n, q in all_queries().items() if not only or n in only}
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        _read_all(all_queries()["b_airport_popularity_top10"](spark, warm_dir))

    times = {}
    for name, query in queries.items():
        if name.startswith("s_") and "replay" not in times:
            times["replay"] = _seconds(lambda: shared_topic(spark, sf_dir))
        times[name] = _seconds(lambda: _read_all(query(spark, sf_dir)))
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of all registered queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
