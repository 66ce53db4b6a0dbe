"""Times the headline queries; prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import time

from ledgerline.plans import registry
from ledgerline.session import get_session

HEADLINE = ["flagship", "op_t2", "op_t8", "op_t16_a17", "op_t18_j11", "op_ratios_p6_p7_p8", "op_valuation_j14", "op_a9_a11_a12_a13_c1", "op_c3", "op_j6_f3", "op_j10", "op_o4", "op_w1", "op_f7"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    found = registry.queries()
    registry.flagship(spark, sf_dir).collect()  # starts workers and compiles
    times: dict[str, float] = {}
    for name in HEADLINE:
        began = time.perf_counter()
        found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
