"""Sinks and scans: versioned snapshots are write-once per version, appends add rows,
typed source scans read what was written."""

import os
import uuid

from culvert.session import checkpoint_dir
from culvert.sources import io
from culvert.sources.fixtures import derive_sources
from culvert.sources.schemas import SOURCE_SCHEMAS


def test_snapshot_versions_and_append(spark):
    base = os.path.join(checkpoint_dir(spark), f"io-{uuid.uuid4().hex}")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert io.overwrite_snapshot(df, base, 0)
    assert not io.overwrite_snapshot(df.limit(1), base, 0)       # committed version is kept
    assert io.overwrite_snapshot(df.limit(1), base, 3)
    assert io.committed_versions(spark, base) == [0, 3]
    assert io.read_latest(spark, base).count() == 1
    assert io.read_latest(spark, base, before=3).count() == 2
    app = os.path.join(base, "appended")
    io.append_rows(df, app)
    io.append_rows(df, app)
    assert spark.read.parquet(app).count() == 4


def test_load_sources_typed_scan(spark, sf_small):
    base = os.path.join(checkpoint_dir(spark), f"src-{uuid.uuid4().hex}")
    src = derive_sources(spark, sf_small)
    for n in ("epdrpipe", "workorders"):
        src[n].write.parquet(os.path.join(base, n))
    got = io.load_sources(spark, base, ["epdrpipe", "workorders"])
    for n, df in got.items():
        assert df.schema == SOURCE_SCHEMAS[n]
        assert df.count() == src[n].count()
