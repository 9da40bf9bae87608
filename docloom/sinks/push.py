"""Send actions to a store outside Spark through a client object, with retries.

Writes take effect at once and a repeated task repeats them: delivery is at least once. :func:`push_resumable` remembers
what has been acknowledged and does not send it again. For exact results apply actions to a store table instead.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import actions as A
from docloom.operators.metrics import TEMPORARY_FAILURE, TIMED_OUT
from docloom.schemas import ACTIONS, ATTEMPTS
from docloom.sources.files import arrow_path
from docloom.sources.tables import exists, stored_whole


class StoreClient(Protocol):
    """What a client must offer. One is made per task."""

    def store(self, op: str, key: str, value: str | None, expiry: int) -> str:
        """Carry out one action and return its status, ``"Success"`` if it worked. May raise TimeoutError."""

    def close(self) -> None: ...


class TotalWaitExceeded(RuntimeError):
    """A task waited longer for retries than it is allowed to."""


def push_attempts(
    actions: DataFrame,
    client: Callable[[], StoreClient],
    *,
    ordered: bool = False,
    max_tries: int = 16,
    max_wait_ms: int = 1000,
    max_total_wait_ms: int = 60_000,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Push ``actions`` and return the attempt log ``(doc_id, seq, op, try_no, status, wait_ms)``.

    The log is lazy: each evaluation pushes again, so use :func:`push_actions` to push once. Only a
    temporary failure is retried, after ``min(2^n, max_wait_ms)`` ms, at most ``max_tries`` times; then the
    failure stays in the log. A task whose waits reach ``max_total_wait_ms`` fails.

    Unordered, every input partition is pushed where it is, with no shuffle. ``ordered`` brings the
    actions of a key into one task in ``seq`` order; batches are streamed, a key is never held in memory.
    """
    send = _Sender(max_tries, max_wait_ms, max_total_wait_ms, sleep)

    def push_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        connection, waits = client(), send.waits()
        try:
            for batch in batches:
                log = [x for action in batch.itertuples(index=False, name=None) for x in send(connection, action, waits)]
                yield pd.DataFrame(log, columns=ATTEMPTS.names)
        finally:
            connection.close()

    return _sendable(actions, ordered).mapInPandas(push_partition, ATTEMPTS)


def _sendable(actions: DataFrame, ordered: bool) -> DataFrame:
    rows = actions.where(F.col("op").isin(*A.OPERATIONS) & (F.col("op") != A.NONE)).select(
        "doc_id",
        F.col("seq").cast("bigint").alias("seq"),
        F.when(F.col("op") == A.EXISTS, A.TOUCH).otherwise(F.col("op")).alias("op"),
        "value",
        F.coalesce("expiry", F.lit(0)).cast("int").alias("expiry"),
    )
    return rows.repartition("doc_id").sortWithinPartitions("doc_id", "seq") if ordered else rows


class Waits:
    """Milliseconds that a task has waited for retries."""

    def __init__(self) -> None:
        self.total = 0


class _Sender:
    """One action at a time to a client: the log rows of its attempts."""

    def __init__(self, max_tries: int, max_wait_ms: int, max_total_wait_ms: int, sleep: Callable[[float], None]):
        self.max_tries, self.max_wait_ms, self.max_total_wait_ms, self.sleep = max_tries, max_wait_ms, max_total_wait_ms, sleep

    def waits(self) -> Waits:
        return Waits()

    def __call__(self, connection: StoreClient, action: tuple, waits: Waits) -> list[tuple]:
        key, seq, op, value, expiry = action
        log = []
        for try_no in range(self.max_tries + 1):
            try:
                status = connection.store(op, key, value, expiry)
            except TimeoutError:
                status = TIMED_OUT
            retry = status == TEMPORARY_FAILURE and try_no < self.max_tries
            wait = min(2**try_no, self.max_wait_ms) if retry else 0
            log.append((key, seq, op, try_no, status, wait))
            if not retry:
                break
            self.sleep(wait / 1000)
            waits.total += wait
            if waits.total >= self.max_total_wait_ms:
                raise TotalWaitExceeded(f"waited {waits.total} ms, allowed {self.max_total_wait_ms} ms")
        return log


def push_actions(actions: DataFrame, client: Callable[[], StoreClient], log_path: str, **options) -> DataFrame:
    """Push ``actions`` once, keep the attempt log at ``log_path`` and return it."""
    push_attempts(actions, client, **options).write.parquet(log_path)
    return actions.sparkSession.read.schema(ATTEMPTS).parquet(log_path)


_LOG = pa.schema(
    [("doc_id", pa.string()), ("seq", pa.int64()), ("op", pa.string()), ("try_no", pa.int32()), ("status", pa.string()), ("wait_ms", pa.int32())]
)


def push_resumable(
    actions: DataFrame,
    client: Callable[[], StoreClient],
    root: str,
    *,
    ordered: bool = False,
    log_every: int = 100,
    max_tries: int = 16,
    max_wait_ms: int = 1000,
    max_total_wait_ms: int = 60_000,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Push ``actions`` and return the attempt log; called again after a failure, it goes on with what is left.

    The first call stores the actions under ``root``; later calls use those, whatever they are given. While a task pushes, it
    writes the attempts of finished actions to small log files there, ``log_every`` actions in each, and what it has when
    it ends or fails. A task that Spark repeats reads the log of its own partition first, a later call leaves out every
    logged action by an anti-join on ``(doc_id, seq)``, which must tell the actions apart. So an action is sent again only
    if it was answered after the last log file of a worker that was killed, or died, without a chance to write (Spark kills
    the other tasks of a job that fails); ``log_every=1`` leaves the one in flight. An action whose tries are used up counts as finished.

    ``root`` must be a folder that executors can write through Arrow's file systems: a mounted path, ``hdfs://``, ``s3://``.
    """
    spark = actions.sparkSession
    root = root.rstrip("/")
    stored, log = f"{root}/actions", f"{root}/log"
    if not stored_whole(spark, stored):
        _sendable(actions, False).write.mode("overwrite").parquet(stored)
    left = spark.read.schema(ACTIONS).parquet(stored).select("doc_id", "seq", "op", "value", "expiry")
    if exists(spark, log):
        done = _read_log(spark, log).select(F.col("doc_id").alias("_id"), F.col("seq").alias("_seq")).distinct()
        left = left.join(done, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("seq") == F.col("_seq")), "left_anti")
    send, run = _Sender(max_tries, max_wait_ms, max_total_wait_ms, sleep), uuid.uuid4().hex

    def push_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        logged = _PartitionLog(f"{log}/run-{run}/{TaskContext.get().partitionId()}")
        done = logged.done()
        connection, waits, held = client(), send.waits(), 0
        try:
            for batch in batches:
                for action in batch.itertuples(index=False, name=None):
                    if action[:2] not in done:
                        logged.rows += send(connection, action, waits)
                        held += 1
                        if held % log_every == 0:
                            logged.write()
        finally:
            logged.write()
            connection.close()
        yield pd.DataFrame({"sent": [held]})

    _sendable(left, ordered).mapInPandas(push_partition, "sent bigint").write.format("noop").mode("overwrite").save()
    return _read_log(spark, log)


class _PartitionLog:
    """Log files of one partition, written where Spark reads them."""

    def __init__(self, folder: str):
        self.fs, self.folder = arrow_path(folder)
        self.rows: list[tuple] = []

    def done(self) -> set[tuple]:
        """Key and ``seq`` of the actions that earlier attempts of this task have logged."""
        found = self.fs.get_file_info(pa.fs.FileSelector(self.folder, allow_not_found=True))
        tables = [pq.read_table(x.path, filesystem=self.fs, columns=["doc_id", "seq"]) for x in found if x.path.endswith(".parquet")]
        return {x for t in tables for x in zip(t["doc_id"].to_pylist(), t["seq"].to_pylist(), strict=True)}

    def write(self) -> None:
        """The held rows as one more file; it gets its name only when it is complete."""
        if not self.rows:
            return
        self.fs.create_dir(self.folder, recursive=True)
        name = f"{self.folder}/{uuid.uuid4().hex}"
        columns = [pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), _LOG.types, strict=True)]
        pq.write_table(pa.table(columns, schema=_LOG), f"{name}.tmp", filesystem=self.fs)
        self.fs.move(f"{name}.tmp", f"{name}.parquet")
        self.rows = []


def _read_log(spark: SparkSession, log: str) -> DataFrame:
    if not exists(spark, log):
        return spark.createDataFrame([], ATTEMPTS)
    return spark.read.schema(ATTEMPTS).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(log)
