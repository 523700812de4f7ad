"""Time the design generators at the original workload sizes (README table).

usage: python tools/design_workloads.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from designlab.operators.doe import DesignSpace  # noqa: E402
from designlab.session import get_spark  # noqa: E402

# Level counts of the ten parameters (419,904 combinations); names and values are neutral
LEVELS = (3, 3, 4, 3, 3, 4, 3, 6, 6, 3)
SPACE = {"parameters": {f"x{i}": {"values": [float(10 * (i + 1) + k) for k in range(n)], "unit": "m", "scaling_factor": 0.001}
                        for i, n in enumerate(LEVELS)}}


def main() -> None:
    spark = get_spark("local[8]", shuffle_partitions=16)
    path = os.path.join(tempfile.mkdtemp(prefix="designlab-space-"), "space.json")
    with open(path, "w") as f:
        json.dump(SPACE, f)
    ds = DesignSpace.from_json(spark, path, koh=1.0)
    for label, build in [("full factorial", ds.full_factorial),
                         ("latin hypercube 1e6", lambda: ds.latin_hypercube(1_000_000, seed=1)),
                         ("maximin 200 x 10000", lambda: ds.maximin_latin_hypercube(200, 10_000, seed=1))]:
        t0 = time.perf_counter()
        n = build().count()
        print(json.dumps({"workload": label, "rows": n, "sec": round(time.perf_counter() - t0, 2)}))
    spark.stop()


if __name__ == "__main__":
    main()
