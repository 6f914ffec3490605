"""Query timings: one JSON line on stdout.  ``value`` is the sum of the headline
queries; ``queries`` has every query of the reference's operators.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and then fully executed into Spark's ``noop`` sink
(every row computed, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vachan.plans.queries import QUERIES  # noqa: E402
from vachan.session import get_spark  # noqa: E402

HEADLINE = ["system_wer", "lattice_system_wer", "tier_sample", "wer_before_after", "code_switch",
            "number_words", "pack_chunks", "clean_text", "token_rewrite", "json_words", "wave_slice",
            "speaker_split"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or [*HEADLINE, *(q for q in QUERIES if q not in HEADLINE)]
    spark = get_spark("vachan-bench", f"local[{cpus}]", max(8, cpus * 2))
    # warm the JVM and the Python workers once, outside the timings
    QUERIES["utterance_wer"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(t for q, t in times.items() if q in HEADLINE or sys.argv[1:]), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
