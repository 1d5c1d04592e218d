"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is executed fully (``write.format("noop")`` forces every row through the plan
without collecting to the driver), once to warm up and then ``$BENCH_REPEAT`` times; the
reported time per query is the median of the warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "c21_luck",            # flagship: matchpoints -> session x pair -> luck -> skill percentile
    "w07_matchpoints",
    "a09_session_pair",
    "w04_rank_pct",
    "j01_left",
    "j10_roles",
    "j06_chain",
    "a03_first_last",
    "c01_contract",
    "c30_score",
    "a24_ev",
    "c29_hand_features",
    "c08_makes",
    "q04b_grouping_sets",
    "q04j_range_join",
    "q04k_asof",
    "s06_json_tables",
    "s18_html_links",
    "i12_session_windows",
    "m01_ridge",
    "m03_isotonic",
    "j20_asof",
    "s12_csv",
    "i05_upsert",
    "i07_stream_dedupe",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from bidbox.plans import QUERIES, load_all
    from bidbox.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="bidbox-bench")
    load_all()
    names = only or HEADLINE
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        fn = QUERIES[name]
        runs = []
        try:
            for i in range(repeat + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                if i > 0:
                    runs.append(dt)
        except Exception as e:  # keep measuring the others; report the failure
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            times[name] = None
            print(f"{name}: FAILED {failed[name]}", file=sys.stderr)
            continue
        times[name] = round(statistics.median(runs), 3)
        print(f"{name}: {times[name]:.3f}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = round(sum(v for v in times.values() if v is not None), 3)
    out = {"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
