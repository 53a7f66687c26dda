"""Deployment entry points over parquet sources: views published and written, sync run once."""

import os
import uuid

from culvert import jobs
from culvert.checks.catalog import Ctx
from culvert.session import checkpoint_dir
from culvert.sources.io import write_feed


def test_views_and_sync_from_parquet_sources(spark, sf_small):
    c = Ctx(spark, sf_small)
    base = os.path.join(checkpoint_dir(spark), f"jobs-{uuid.uuid4().hex}")
    src_dir, out_dir, state_dir, feed_dir = (os.path.join(base, x) for x in ("src", "out", "state", "feed"))
    for n, df in c.src.items():
        df.write.parquet(os.path.join(src_dir, n))
    want = c.unified().count()
    assert jobs.publish_views(spark, src_dir) == ["inspections_v"]
    assert spark.table("inspections_v").count() == want

    jobs.init_from(spark, c.stg, c.queue, c.empty_cr(), state_dir)
    write_feed(c.feed, feed_dir, files=1)
    jobs.start_sync(spark, src_dir, feed_dir, state_dir, once=True).awaitTermination()
    jobs.write_views(spark, src_dir, out_dir, state_dir)
    assert spark.read.parquet(os.path.join(out_dir, "inspections")).count() == want
    sent = spark.read.parquet(os.path.join(out_dir, "cr_inspect_to_send"))
    assert sent.count() == c.collected().count()
    assert len(sent.columns) == 41
