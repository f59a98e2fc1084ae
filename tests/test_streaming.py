"""Landing files as a stream gives what a batch over the same files gives."""

from rollcall.operators.feed import flatten_feed
from rollcall.sources import xml
from rollcall.streaming.landing import feed_stream, land
from tests.test_jobs import FEED, put


def test_feed_stream_equals_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(3):
        put(source, f"f{i}.xml", FEED.replace(">A<", f">A{i}<"))
        land(feed_stream(spark, str(source), files_per_batch=1), out, str(tmp_path / "ckpt")).awaitTermination()
    batch = flatten_feed(xml.read_feed(spark, str(source)))
    landed = spark.read.parquet(out)
    assert landed.count() == 6
    assert landed.exceptAll(batch).isEmpty() and batch.exceptAll(landed).isEmpty()
