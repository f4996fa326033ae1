"""What running streams report of themselves, as tables."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "query_id string, run_id string, batch bigint, at string, input_rows bigint, late_rows bigint, "
    "state_rows bigint, observed map<string,string>"
)


class ProgressTable(StreamingQueryListener):
    """Collects a row per batch of every stream of the session, until ``take`` hands them out.

    ``late_rows`` are what the watermark dropped: rows as they reach the state, so after partial aggregation
    the groups that came late. ``observed`` has the metrics of ``DataFrame.observe`` as JSON, by name.
    Spark reports in the background; ``wait`` returns once all of a query that has ended is in.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.rows: list[tuple] = []
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        row = (
            str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows,
            sum(s.numRowsDroppedByWatermark for s in state), sum(s.numRowsTotal for s in state),
            {name: json.dumps(r.asDict(), default=str) for name, r in p.observedMetrics.items()},
        )
        with self.changed:
            self.rows.append(row)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Block until everything that a query reported has arrived."""
        with self.changed:
            if not self.changed.wait_for(lambda: str(query.runId) in self.ended, seconds):
                raise TimeoutError(f"no end of query {query.id} was reported in {seconds} seconds")

    def take(self) -> DataFrame:
        """The rows collected so far, which are handed out once; write them where they shall stay."""
        with self.changed:
            rows, self.rows = self.rows, []
        return self.spark.createDataFrame(rows, PROGRESS)
