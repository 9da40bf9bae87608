"""Whole jobs: import a view to files or cells, export lines into a store, update a store."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docloom.operators.keys import key_intervals, place_by_chunk, plan_keys
from docloom.operators.metrics import (
    LINES_WITH_WRONG_COLUMNS_COUNT,
    attempt_counters,
    outcome_counters,
    update_counters,
)
from docloom.operators.paging import page_rows
from docloom.operators.uniform import apply_operation
from docloom.operators.update import Merge, update_documents
from docloom.operators.view_changes import Define
from docloom.operators.views import (
    MAX_LITERAL_KEYS,
    asked_for,
    documents_of,
    key_parts,
    missing_documents,
    scan_view,
    to_cells,
    within,
)
from docloom.schemas import METRICS
from docloom.sinks.cells import write_cells
from docloom.sinks.push import StoreClient, push_resumable
from docloom.sinks.store import change_store
from docloom.sinks.text import write_kv_text, write_page_files, write_pages
from docloom.sources.buckets import documents_by_id
from docloom.sources.lines import ParsedLines, parse_action_lines, read_lines
from docloom.sources.outside import FETCHED, ReadClient, call_counters, fetch_documents, with_existing
from docloom.sources.tables import materialize, stored_whole


@dataclass(frozen=True)
class ImportReport:
    """What an import read: scanned rows with their key, and the count of rows without document."""

    rows: DataFrame
    counters: DataFrame


def scan_keys(
    view: DataFrame, key_spec: str, store: DataFrame | str | None = None, *, num_chunks: int | None = None
) -> DataFrame:
    """Rows of all keys of a key spec, with ``key_ord`` and ``chunk_id``.

    ``store``, here and in the imports, is a table of documents or the folder of a bucketed store, of which only the
    buckets of the documents asked for are opened.
    """
    keys = plan_keys(view.sparkSession, key_spec, num_chunks=num_chunks)
    keys = keys.select("view_key", "key_ord", "chunk_id")
    if key_parts(view) and keys.limit(MAX_LITERAL_KEYS + 1).count() > MAX_LITERAL_KEYS:
        # Too many keys for literals: the ranges of the spec prune in their place.
        view = within(view, key_intervals(view.sparkSession, key_spec, len(key_parts(view))))
    if not isinstance(store, str):
        return scan_view(view, keys, store)
    rows = scan_view(view, keys)
    return (rows.drop("value") if "value" in rows.columns else rows).join(_documents_for(store, rows), "doc_id", "left")


def _documents_for(store: DataFrame | str, rows: DataFrame) -> DataFrame:
    """``(doc_id, value)`` of the documents that ``rows`` name."""
    if isinstance(store, str):
        return documents_by_id(rows.sparkSession, store, rows).select("doc_id", "value")
    return asked_for(store.select("doc_id", "value"), rows)


def import_view(
    view: DataFrame,
    key_spec: str,
    path: str,
    store: DataFrame | str | None = None,
    *,
    num_chunks: int | None = None,
    by_chunk: bool = False,
    separator: str = "\t",
    escape: bool = True,
) -> ImportReport:
    """Write the documents of the listed keys as key-value text.

    With ``by_chunk`` (and ``num_chunks``) each chunk of keys is one task's and one file's, as where the chunks are the
    splits of the import; the rows are moved for that. Else they are written where they are read.
    """
    rows = scan_keys(view, key_spec, store, num_chunks=num_chunks)
    placed = rows
    if by_chunk:
        if num_chunks is None:
            raise ValueError("by_chunk needs num_chunks")
        placed = place_by_chunk(rows, num_chunks)
    write_kv_text(documents_of(placed), path, separator=separator, escape=escape)
    return ImportReport(rows, missing_documents(rows))


def import_view_to_cells(
    view: DataFrame,
    key_spec: str,
    path: str,
    family: str,
    qualifier: str,
    store: DataFrame | str | None = None,
    *,
    num_chunks: int | None = None,
) -> ImportReport:
    """Write the documents of the listed keys as a cell table.

    With a store, IDs are made distinct before their documents are looked up, so no document is reduced.
    """
    rows = scan_keys(view, key_spec, num_chunks=num_chunks)
    if store is None:
        write_cells(to_cells(rows, family, qualifier, order="key_ord"), path)
        return ImportReport(rows, missing_documents(rows))
    documents = _documents_for(store, rows)
    ids = rows.where(rows["doc_id"].isNotNull()).select("doc_id").distinct()
    write_cells(to_cells(ids.join(documents, "doc_id"), family, qualifier, unique=True), path)
    found = (rows.drop("value") if "value" in rows.columns else rows).join(documents, "doc_id", "left")
    return ImportReport(found, missing_documents(found))


def import_view_paged(
    view: DataFrame,
    key_spec: str,
    path: str,
    store: DataFrame | str | None = None,
    *,
    page_size: int = 1024,
    num_chunks: int | None = None,
    separator: str = "\t",
    escape: bool = True,
    flat: bool = False,
) -> ImportReport:
    """Write the documents of the listed keys as numbered pages, numbered over all keys.

    Each page is a folder with a file in it, or with ``flat`` a file ``part-NNNNN`` (:func:`write_page_files`).

    Index rows are paged before the documents are looked up, so paging moves narrow rows. A row without
    document keeps its place in the page but writes no line.
    """
    rows = scan_keys(view, key_spec, num_chunks=num_chunks)
    paged = page_rows(rows, page_size)
    if store is not None:
        documents = _documents_for(store, rows)
        paged = paged.join(documents, "doc_id", "left")
    if flat:
        write_page_files(paged, path, separator=separator, escape=escape)
    else:
        write_pages(paged.where(paged["value"].isNotNull()), path, separator=separator, escape=escape)
    return ImportReport(paged, missing_documents(paged))


@dataclass(frozen=True)
class ExportReport:
    version: int
    outcomes: DataFrame
    rejects: DataFrame
    counters: DataFrame


def export_lines(
    spark: SparkSession,
    path: str | list[str],
    root: str,
    as_of: dt.datetime | str,
    *,
    op: str | None = None,
    expiry: int | str | None = None,
    delimiter: str = "\t",
    literal: bool = False,
    escaped: bool = False,
    views: Mapping[str, Define] | None = None,
) -> ExportReport:
    """Apply a delimited file with one operation to the store under ``root``; saves the next version.

    ``views`` that follow the store are brought up to date (see ``change_store``).

    The lines are read and parsed once, into the shared scratch folder; what follows reads the columns it needs from there.
    Rejects are counted on the way, by an observation of that job (a stage that Spark runs again may count some twice;
    ``reject_counters(report.rejects)`` counts them from the lines).
    """
    seen = Observation("lines")
    lines = parse_action_lines(
        read_lines(spark, path), op, expiry, delimiter=delimiter, literal=literal, escaped=escaped
    )
    rejected = F.count_if(F.col("reject_reason").isNotNull()).alias("rejected")
    actions = materialize(ParsedLines(lines.parsed.observe(seen, rejected)).actions, "export-actions")
    version, result = change_store(
        spark,
        root,
        actions,
        lambda store: apply_operation(store, actions, op, as_of, expiry=expiry, unique_seq=True),
        views,
    )
    rejects = spark.createDataFrame([(LINES_WITH_WRONG_COLUMNS_COUNT, seen.get["rejected"])], METRICS)
    counters = outcome_counters(result.outcomes).union(rejects)
    return ExportReport(version, result.outcomes, lines.rejects, counters)


@dataclass(frozen=True)
class UpdateReport:
    version: int
    summary: DataFrame
    counters: DataFrame


def update_job(
    source: DataFrame,
    root: str,
    merge: Merge,
    as_of: dt.datetime | str,
    *,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    order_by: str | None = None,
    reduce: Sequence[Column] | None = None,
    views: Mapping[str, Define] | None = None,
) -> UpdateReport:
    """Update the store under ``root`` from ``source``; saves the next version, and ``views`` follow it."""
    rows = transform(source) if transform else source
    version, result = change_store(
        source.sparkSession,
        root,
        rows,
        lambda store: update_documents(store, rows, merge, as_of, order_by=order_by, reduce=reduce),
        views,
    )
    return UpdateReport(version, result.summary, update_counters(result.summary))


@dataclass(frozen=True)
class OutsideReport:
    attempts: DataFrame
    counters: DataFrame


def update_outside(
    source: DataFrame,
    reader: Callable[[], ReadClient],
    writer: Callable[[], StoreClient],
    merge: Merge,
    root: str,
    *,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    seq: str = "seq",
    batch_size: int = 1024,
    **push_options,
) -> OutsideReport:
    """Update a store outside Spark: fetch the documents of the source's keys in bulk, merge, push the actions.

    Every source row is merged with the document as it was fetched. Answers and log are kept under ``root``, and a call
    after a failure fetches only what was not fetched in full, and pushes only what is not logged.
    """
    spark = source.sparkSession
    rows = (transform(source) if transform else source).where("doc_id IS NOT NULL AND doc_id != ''")
    fetched_at = f"{root.rstrip('/')}/fetched"
    if stored_whole(spark, fetched_at):
        fetched = spark.read.schema(FETCHED).parquet(fetched_at)
    else:
        fetched = fetch_documents(rows, reader, fetched_at, batch_size=batch_size)
    payload = F.struct(*[c for c in rows.columns if c != "doc_id"])
    merged = with_existing(rows, fetched).select("doc_id", F.col(seq).alias("seq"), merge(payload, F.col("existing")).alias("a"))
    attempts = push_resumable(merged.select("doc_id", "seq", "a.*"), writer, f"{root.rstrip('/')}/pushed", **push_options)
    return OutsideReport(attempts, call_counters(fetched).union(attempt_counters(attempts)))
