"""Streaming Elo equals the batch fold when results arrive in order."""

import os
import tempfile

from pyspark.sql import functions as F

from pitchspark.operators import ratings as rt
from pitchspark.session import ensure_checkpoint_dir
from pitchspark.sources.fixtures import fixture
from pitchspark.streaming.elo_stream import stream_elo

from conftest import SMALL


def test_stream_elo_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="stream-", dir=ensure_checkpoint_dir(spark).replace("file:", ""))
    m = fixture(spark, SMALL, "fx_matches").where(F.col("pool") < 3)
    cut = m.agg(F.percentile_approx("date", 0.5)).first()[0]
    src = os.path.join(base, "src")
    # two arrivals in date order
    m.where(F.col("date") <= cut).write.parquet(os.path.join(src, "b1"))
    schema = m.schema
    q = (stream_elo(spark.readStream.schema(schema).parquet(os.path.join(src, "*")))
         .writeStream.format("memory").queryName("elo_stream_out").outputMode("append")
         .option("checkpointLocation", os.path.join(base, "ckpt")).start())
    q.processAllAvailable()
    m.where(F.col("date") > cut).write.parquet(os.path.join(src, "b2"))
    q.processAllAvailable()
    q.stop()
    got = {r.match_id: (r.elo_a, r.elo_b) for r in spark.table("elo_stream_out").collect()}
    prepared = rt.prepare_matches(m)
    want = {r.match_id: (r.elo_a, r.elo_b) for r in rt.elo_ratings(prepared, pool="pool").collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k][0] - want[k][0]) < 1e-9 and abs(got[k][1] - want[k][1]) < 1e-9
    assert spark.table("elo_stream_out").where("late").count() == 0
