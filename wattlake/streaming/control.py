"""Start, watch and stop streaming queries."""

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from wattlake.sources.files import exists

PROGRESS = "name string, batch_id long, stamp string, input_rows long, rows_per_second double"


def start(
    writer: DataStreamWriter, name: str, checkpoint: str, every: str | None = "30 seconds",
    drain: bool = False,
) -> StreamingQuery:
    """``checkpoint`` must be durable. ``drain`` handles what is there and ends;
    ``every=None`` starts the next batch as soon as the last one ends."""
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def run_all(spark: SparkSession, queries: list[StreamingQuery], poll: int = 60, report=print,
            log: "ProgressLog | None" = None) -> None:
    """Waits until all have ended, with a status report every ``poll`` seconds. If
    one fails, the others are stopped and the error is raised, so that a restart
    resumes all of them from their checkpoints."""
    spark.streams.resetTerminated()  # forget queries of earlier jobs
    try:
        while any(q.isActive for q in queries):
            spark.streams.awaitAnyTermination(poll)
            spark.streams.resetTerminated()
            _raise_failures(queries)
            report(status(queries))
            if log is not None:
                log.flush()
        _raise_failures(queries)
    finally:
        for query in queries:
            query.stop()
        if log is not None:
            log.finish(queries)


def _raise_failures(queries: list[StreamingQuery]) -> None:
    for query in queries:
        if not query.isActive:
            query.awaitTermination()


def drain_all(queries: list[StreamingQuery]) -> None:
    """For queries that end by themselves."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def status(queries: list[StreamingQuery]) -> list[dict]:
    return [{"name": q.name, "active": q.isActive, **q.status} for q in queries]


class ProgressLog(StreamingQueryListener):
    """Stores a row for every batch of every query of the session.

    Spark itself keeps the last hundred reports of a query. Rows are gathered as they
    come and appended to ``path`` by ``flush``; ``run_all`` does that at every poll.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._rows, self._ended, self._change = [], set(), threading.Condition()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (p.name, p.batchId, p.timestamp, p.numInputRows, float(p.processedRowsPerSecond or 0.0))
        with self._change:
            self._rows.append(row)

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def flush(self) -> None:
        with self._change:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def finish(self, queries: list[StreamingQuery], seconds: float = 60.0) -> DataFrame:
        """After the queries ended: waits for their last reports and gives the table."""
        wanted = {str(q.runId) for q in queries}
        with self._change:
            if not self._change.wait_for(lambda: wanted <= self._ended, seconds):
                raise TimeoutError("no end reported for a query that ended")
        self.spark.streams.removeListener(self)
        self.flush()
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], PROGRESS)
        return self.spark.read.schema(PROGRESS).parquet(self.path)
