"""Documents of a store outside Spark, fetched many at a time through a client object."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.metrics import BULK_SIZES_SUM, BULKS_COUNT, as_counters

FETCHED = "doc_id STRING, existing STRING, lane INT, call_no INT, tries INT"


class ReadClient(Protocol):
    """What a client must offer. One is made per task."""

    def get_many(self, keys: list[str]) -> dict[str, str]:
        """The documents of those keys that have one. May raise TimeoutError, and then is asked again."""

    def close(self) -> None: ...


def fetch_documents(
    rows: DataFrame,
    client: Callable[[], ReadClient],
    path: str,
    *,
    batch_size: int = 1024,
    max_tries: int = 16,
    max_wait_ms: int = 1000,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Fetch the document of every distinct ``doc_id`` of ``rows`` once and keep the answers at ``path``.

    Gives ``(doc_id, existing, lane, call_no, tries)``: ``existing`` is null where the store has no document; ``lane`` and
    ``call_no`` tell the task and the call. Keys are dealt to tasks by hash and asked for in order, at most ``batch_size``
    in a call, so a task of n keys makes ceil(n / batch_size) calls; batches are streamed. A call that times out is
    repeated after 1, 2, 4, ... ms, at most ``max_wait_ms``; after ``max_tries`` repetitions the task fails.
    """
    keys = rows.where("doc_id IS NOT NULL AND doc_id != ''").select("doc_id").distinct()

    def ask(connection: ReadClient, asked: list[str], call_no: int) -> pd.DataFrame:
        for tries in range(1, max_tries + 2):
            try:
                found = connection.get_many(asked)
                break
            except TimeoutError:
                if tries > max_tries:
                    raise
                sleep(min(2 ** (tries - 1), max_wait_ms) / 1000)
        lane = TaskContext.get().partitionId()
        return pd.DataFrame(
            {"doc_id": asked, "existing": [found.get(k) for k in asked], "lane": lane, "call_no": call_no, "tries": tries}
        )

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        connection, held, call_no = client(), [], 0
        try:
            for batch in batches:
                held += batch["doc_id"].tolist()
                while len(held) >= batch_size:
                    yield ask(connection, held[:batch_size], call_no)
                    held, call_no = held[batch_size:], call_no + 1
            if held:
                yield ask(connection, held, call_no)
        finally:
            connection.close()

    keys.repartition("doc_id").sortWithinPartitions("doc_id").mapInPandas(fetch, FETCHED).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(FETCHED).parquet(path)


def with_existing(rows: DataFrame, fetched: DataFrame) -> DataFrame:
    """``rows`` with ``existing``, the fetched document of their key."""
    return rows.join(fetched.select("doc_id", "existing"), "doc_id", "left").select(*rows.columns, "existing")


def call_counters(fetched: DataFrame) -> DataFrame:
    """Calls made and keys asked for, as metrics rows: what the calls were, not what they should have been."""
    calls = fetched.groupBy("lane", "call_no").agg(F.count(F.lit(1)).alias("n"))
    return as_counters(calls, {BULKS_COUNT: F.count(F.lit(1)), BULK_SIZES_SUM: F.sum("n")})
