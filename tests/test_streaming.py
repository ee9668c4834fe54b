"""The staging projection runs unchanged on a streaming DataFrame."""

from __future__ import annotations

import os
import tempfile

from conftest import SF_SMALL

from starweave.plans import stg_orders
from starweave.sources import raw_orders_from_tpch, struct_type


def test_staging_on_a_stream_equals_batch(spark):
    scratch = tempfile.mkdtemp(prefix="starweave-stream-")
    raw_dir = os.path.join(scratch, "raw")
    raw_orders_from_tpch(spark, SF_SMALL).write.parquet(raw_dir)
    stream = (spark.readStream.schema(struct_type("orders", drop=("row_id",)))
              .option("maxFilesPerTrigger", 1).parquet(raw_dir))
    q = (stg_orders(stream).writeStream.format("memory").queryName("stg_stream")
         .option("checkpointLocation", os.path.join(scratch, "ckpt"))
         .outputMode("append").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(map(tuple, spark.table("stg_stream").collect()), key=str)
    want = sorted(map(tuple, stg_orders(spark.read.parquet(raw_dir)).collect()), key=str)
    assert got == want
