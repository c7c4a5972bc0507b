"""Time every query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line.

Each query runs to a sink that discards its rows. One untimed query warms the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

from coursegrain.bindings import REGISTRY
from coursegrain.session import local_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:]
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    REGISTRY["profile_shape"](spark, folder).collect()
    seconds: dict[str, float] = {}
    for name, query in REGISTRY.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds over all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
