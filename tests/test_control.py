"""Batches after a failure, after one of two fails, after an interrupt, and without a trigger."""

import pytest
from pyspark.errors import StreamingQueryException

from wattlake.streaming import control


@pytest.fixture
def stream(spark, folder):
    """Three files, a batch each."""
    source = folder("source")
    spark.range(0, 6, 1, 3).write.parquet(source)
    return lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source).writeStream


def collecting(seen, fail_at=None):
    def write(batch, batch_id):
        if batch_id == fail_at:
            raise ValueError("no such sink")
        seen.append((batch_id, sorted(r.id for r in batch.collect())))

    return write


def test_without_a_trigger_batches_follow_at_once(stream, folder):
    seen = []
    query = control.start(stream().foreachBatch(collecting(seen)), "asap", folder("cp"), every=None)
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert [b for b, _ in seen] == [0, 1, 2]
    assert sorted(i for _, ids in seen for i in ids) == list(range(6))


def test_a_failed_batch_comes_again(stream, folder):
    cp, before, after = folder("cp"), [], []
    with pytest.raises(StreamingQueryException, match="no such sink"):
        control.drain_all([control.start(stream().foreachBatch(collecting(before, 1)), "fails", cp, drain=True)])
    assert [b for b, _ in before] == [0]
    control.drain_all([control.start(stream().foreachBatch(collecting(after)), "again", cp, drain=True)])
    assert [b for b, _ in after] == [1, 2]
    assert sorted(i for _, ids in before + after for i in ids) == list(range(6))


def test_one_failure_costs_the_other_no_batch(spark, stream, folder):
    places, seen = {"good": folder("cp"), "bad": folder("cp")}, {"good": [], "bad": []}

    def started(name, fail_at=None, **how):
        return control.start(stream().foreachBatch(collecting(seen[name], fail_at)), name, places[name], **how)

    queries = [started("good", every="1 second"), started("bad", 1, every=None)]
    with pytest.raises(StreamingQueryException, match="no such sink"):
        control.run_all(spark, queries, poll=5, report=lambda _: None)
    assert not any(q.isActive for q in queries)
    control.run_all(spark, [started(name, drain=True) for name in seen], poll=5, report=lambda _: None)
    for name in seen:
        # A batch cut off while it ran may come a second time, none is left out.
        batches = dict(seen[name])
        assert sorted(batches) == [0, 1, 2]
        assert sorted(i for ids in batches.values() for i in ids) == list(range(6))


def test_an_interrupt_stops_the_queries_and_loses_nothing(spark, stream, folder):
    cp, seen = folder("cp"), []

    def interrupt(_):
        raise KeyboardInterrupt

    query = control.start(stream().foreachBatch(collecting(seen)), "interrupted", cp, every="1 second")
    with pytest.raises(KeyboardInterrupt):
        control.run_all(spark, [query], poll=1, report=interrupt)
    assert not query.isActive
    control.drain_all([control.start(stream().foreachBatch(collecting(seen)), "resumed", cp, drain=True)])
    assert sorted(dict(seen)) == [0, 1, 2]
    assert sorted(i for ids in dict(seen).values() for i in ids) == list(range(6))
