"""Summarise the physical plans of the main jobs as they would run on large inputs:
automatic broadcast off (only explicit, size-checked broadcasts remain), AQE off so the
static plan is shown. Sources are the derived domain tables written once as parquet."""

from __future__ import annotations

import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from culvert.plans.inspections import unified_inspections  # noqa: E402
from culvert.session import checkpoint_dir, get_spark  # noqa: E402
from culvert.sources.fixtures import derive_sources, derive_state  # noqa: E402
from culvert.sources.io import load_sources  # noqa: E402
from culvert.sources.lookups import all_lookups  # noqa: E402
from culvert.streaming import rules as R  # noqa: E402


def summary(name, df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts = {k: len(re.findall(re.escape(k), plan)) for k in
              ["Exchange hashpartitioning", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
               "Window", "HashAggregate", "FileScan"]}
    print(f"\n### {name}\n")
    print("| operator | count |\n| --- | --- |")
    for k, v in counts.items():
        print(f"| {k} | {v} |")
    joins = [ln.strip() for ln in plan.splitlines() if "SortMergeJoin" in ln]
    if joins:
        print("\nsort-merge join keys:\n")
        for j in joins:
            print("    " + re.sub(r"#\d+L?", "", j.split("SortMergeJoin", 1)[1]).strip())
    pushed = [ln for ln in plan.splitlines() if "PushedFilters: [" in ln and "PushedFilters: []" not in ln]
    if pushed:
        print("\npushed filters:\n")
        for ln in pushed:
            tbl = "scan of [" + re.sub(r"#\d+L?", "", ln.split("FileScan parquet [", 1)[1].split(",", 1)[0]) + ", ..]"
            print(f"    {tbl}: " + re.sub(r"#\d+L?", "", ln.split("PushedFilters: ")[1].split(", ReadSchema")[0]))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[4]", shuffle_partitions=64,
                      extra={"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    base = os.path.join(checkpoint_dir(spark), f"plans-{uuid.uuid4().hex}")
    for n, df in derive_sources(spark, sf).items():
        df.write.parquet(os.path.join(base, "src", n))
    src, lk = load_sources(spark, os.path.join(base, "src")), all_lookups(spark)
    summary("unified_inspections (full view)", unified_inspections(src, lk))
    st = derive_state(spark, sf)
    stg = st["wot_stg"]
    feed = spark.createDataFrame([(1, "x", 58, None)], "seq long, wo_uuid string, site_oi long, reqcompdate_dttm timestamp_ntz")
    summary("propagate_due_date", R.propagate_due_date(stg, feed))


if __name__ == "__main__":
    main()
