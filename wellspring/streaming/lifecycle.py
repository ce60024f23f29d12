"""The life of each request as keyed streaming state."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

# The states of a request, in the order in which it can take them.
STATES = ["queued", "processing", "completed", "failed"]
STAGE_OF = {"queued": 0, "processing": 1, "completed": 2, "failed": 2}

# Groups of requests with counters of their own. The load is the sum of this many rows.
BUCKETS = 64

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

EVENT = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("status", T.StringType())])
COUNTS = T.StructType([T.StructField(name, T.LongType()) for name in STATES])
CHANGE = "query_id string, before string, status string"


class Lifecycle(StatefulProcessor):
    """Per bucket: the state of each request, and how many requests are in each state.

    A request only moves forward, so an event that comes again, or late, changes nothing.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.requests = handle.getMapState("requests", "query_id string", "status string")
        self.counts = handle.getValueState("counts", COUNTS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        counts = dict(zip(STATES, self.counts.get() if self.counts.exists() else (0,) * len(STATES)))
        for events in rows:
            changes = []
            for query_id, status in zip(events["query_id"], events["status"]):
                before = self.requests.getValue((query_id,))[0] if self.requests.containsKey((query_id,)) else None
                if before is not None and STAGE_OF[before] >= STAGE_OF[status]:
                    continue
                if before is not None:
                    counts[before] -= 1
                counts[status] += 1
                self.requests.updateValue((query_id,), (status,))
                changes.append((query_id, before, status))
            yield pd.DataFrame(changes, columns=["query_id", "before", "status"], dtype=object)
        self.counts.update(tuple(counts[name] for name in STATES))

    def close(self) -> None:
        pass


def changes(events: DataFrame) -> DataFrame:
    """Changes of state (query_id, before, status) in a stream of events (query_id, status). Events
    without an id or of a state that there is not are left out."""
    known = events.where(F.col("query_id").isNotNull() & F.col("status").isin(STATES))
    bucket = F.pmod(F.xxhash64("query_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
    return (
        known.select(bucket, "query_id", "status")
        .groupBy("bucket")
        .transformWithStateInPandas(Lifecycle(), CHANGE, outputMode="Update", timeMode="None")
    )


def lifecycle_stream(events: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start following the requests of an event stream; the state lies under ``checkpoint``. The
    session gets the state store that such state needs."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        changes(events)
        .writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def lifecycle_load(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row: requests in each state, as the last micro-batch left them. Reads the counters of
    the buckets alone, whatever the number of requests."""
    state = spark.read.format("statestore").option("stateVarName", "counts").load(checkpoint)
    return state.agg(*[F.coalesce(F.sum(f"value.{name}"), F.lit(0)).alias(name) for name in STATES])
