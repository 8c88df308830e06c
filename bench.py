"""Benchmark: the cleaning job and every registered report at one scale.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8).
Stage 1 runs the full ETL (raw views -> cleaned Parquet + audit) into a
fresh folder under spark.checkpoint.dir; stage 2 runs every report over the written tables,
each forced to completion through the ``noop`` sink (full execution, no
driver collection).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from priceloom.plans import pipeline, registry  # noqa: E402
from priceloom.session import build_session, scratch_path  # noqa: E402
from priceloom.sources import testdata  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="priceloom-bench",
                          extra={"spark.driver.memory": "16g"})
    # Output goes to a fresh folder under the session's shared checkpoint
    # folder (spark.checkpoint.dir, set by the environment; a private one is
    # created only when it is absent).
    out = scratch_path(spark, f"bench-{uuid.uuid4().hex[:12]}")
    times: dict[str, float] = {}

    t0 = time.time()
    raw = testdata.raw_from_testdata(spark, sf_dir)
    audit = pipeline.run_pipeline(spark, raw.customers, raw.products, raw.sales,
                                  testdata.raw_pricing_history, out)
    audit.collect()
    times["etl_pipeline"] = round(time.time() - t0, 3)

    # Reports read the written clean tables and what the bundle derives from
    # them once (the first report that needs a ledger or a fit pays for it);
    # the raw audit also reads the raw inputs.  The round trips through files
    # are queries for correctness, not reports.
    tables = pipeline.read_tables(spark, out, raw=raw)
    for name, fn in registry.catalogue().items():
        if name.startswith("clean_") or name in registry.FILES:
            continue
        t = time.time()
        fn(tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
