"""Jobs as a stream: each micro-batch runs the batch plan; the job contract has no event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import run
from ..plans.validate import validated

STORE, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def once(jobs: DataFrame) -> DataFrame:
    """The first event of each id, over restarts and replays: ids are keyed state in the query's checkpoint.

    Events without an id are told apart by their contents. State grows with the number of ids, as an
    id may come again at any time.
    """
    key = F.coalesce(F.concat(F.lit("id "), "id"), F.concat(F.lit("input "), F.coalesce(F.sha2(F.to_json("input"), 256), F.lit(""))))
    return jobs.withColumn("__key", key).dropDuplicates(["__key"]).drop("__key")


def answer(jobs: DataFrame, path: str, checkpoint: str, plan: Callable[[DataFrame], DataFrame] = validated) -> StreamingQuery:
    """Answers of a stream of jobs as JSON under ``path``, one folder a batch so that a replay overwrites.

    Every event is answered; ``answer_jobs`` runs the whole plan, once for each id.
    """

    def batch(rows: DataFrame, number: int) -> None:
        plan(rows).write.mode("overwrite").json(f"{path.rstrip('/')}/batch={number}")

    return jobs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def answer_jobs(jobs: DataFrame, roles: run.Roles, path: str, checkpoint: str, *, work: str, sink: str, **retries) -> StreamingQuery:
    """Jobs of a stream from events to answers and artifacts: each id is answered once.

    State lives on disk, beyond an executor's memory. A batch that failed half-way runs again with the same
    events and overwrites its answers and artifacts.
    """
    conf = jobs.sparkSession.conf
    before = conf.get(STORE)
    conf.set(STORE, ROCKS)  # read when the query starts
    try:
        return answer(once(jobs), path, checkpoint, lambda rows: run.run(rows, roles, work, sink, **retries))
    finally:
        conf.set(STORE, before)
