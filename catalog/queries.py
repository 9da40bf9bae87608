"""One query per operator, over whole tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import tables as t
from docloom.functions import actions as A
from docloom.functions.expiry import backoff_schedule
from docloom.functions.jsonkeys import is_json_sql
from docloom.functions.keyspec import split_key_spec
from docloom.operators import metrics
from docloom.operators.apply import ApplyResult, apply_actions, apply_to, live_documents
from docloom.operators.composing import update_composed
from docloom.operators.existence import existence_counts, existing_keys, key_existence, missing_keys
from docloom.operators.gate import failed_share
from docloom.operators.keys import expand_keys, plan_keys
from docloom.operators.merging import update_in_order
from docloom.operators.paging import assign_batches, page_rows
from docloom.operators.uniform import apply_operation
from docloom.operators.update import merge_actions, update_documents
from docloom.operators.views import define_view, sample_view, scan_view, to_cells
from docloom.plans import jobs
from docloom.sinks.cells import load_cells, read_cells, read_loaded_cells
from docloom.sinks.push import push_attempts, push_resumable
from docloom.sinks.store import current_store, save_actions
from docloom.sinks.text import kv_lines, page_lines, parse_kv_lines, read_kv_text
from docloom.sources.buckets import create_buckets, documents_by_id, read_buckets
from docloom.sources.lines import parse_action_lines
from docloom.sources.outside import fetch_documents, with_existing
from docloom.sources.tables import read_view, scratch_dir, write_snapshot, write_view
from docloom.sources.view_store import create_view, read_followed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# --- key specs ---------------------------------------------------------------------------------------

CLICK_SPEC = '["202401((01-03))", 0];["20240101",1];["20240101",1]'
ODD_PARTS = ("", "a/b", "k=v", "it's", "null", " ")
TEXT_SPEC = '["en",((0-3))];["de",1];["de",1];["xx",0]'


@query
def key_split(spark, sf_dir):
    """Page sources with other brackets as key-spec texts: quotes, brackets and escapes everywhere."""
    pages = t.load(spark, sf_dir, "pages").select("page_id", F.translate("html", "{}/", "[]\\").alias("spec"))
    return pages.selectExpr("page_id", f"posexplode({split_key_spec('spec')}) AS (pos, raw_key)")


@query
def key_expand(spark, sf_dir):
    keys = expand_keys(t.key_specs(spark, sf_dir), "spec")
    return keys.select("c_custkey", "pos", "sub_pos", "key_ord", "raw_key", "view_key")


@query
def key_chunks(spark, sf_dir):
    keys = expand_keys(t.key_specs(spark, sf_dir), "spec", num_chunks="c_custkey % 5 + 1")
    return keys.groupBy("c_custkey", "chunk_id").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.min("key_ord").alias("first_key"),
        F.max("key_ord").alias("last_key"),
    )


# --- views and scans ---------------------------------------------------------------------------------


@query
def view_define(spark, sf_dir):
    return t.click_view(spark, sf_dir, 2)


@query
def view_sample(spark, sf_dir):
    return sample_view(t.click_view(spark, sf_dir, 10), "k1", 3).select("view_key", "doc_id")


@query
def import_clicks(spark, sf_dir):
    view = t.click_view(spark, sf_dir, 2, include_docs=True)
    keys = plan_keys(spark, CLICK_SPEC).select("view_key", "key_ord")
    return scan_view(view, keys).select("key_ord", "view_key", "doc_id", "value")


@query
def stored_view_scan(spark, sf_dir):
    """The flagship scan over a view stored by day and partition number."""
    path = scratch_dir(spark, "view")
    write_view(t.click_view(spark, sf_dir, 2, include_docs=True), path)
    keys = plan_keys(spark, CLICK_SPEC).select("view_key", "key_ord")
    return scan_view(read_view(spark, path), keys).select("key_ord", "view_key", "doc_id", "value")


@query
def stored_view_odd_keys(spark, sf_dir):
    """A stored view whose parts are empty, missing or hold path and quote characters, read by all its keys."""
    docs = t.load(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("lang").alias("value"),
        F.when(F.col("doc_id") % 7 < 6, F.get(F.array(*[F.lit(x) for x in ODD_PARTS]), (F.col("doc_id") % 7).cast("int"))).alias("part"),
    )
    view = define_view(docs, [F.col("part"), F.col("value")], json_only=False)
    path = scratch_dir(spark, "view")
    write_view(view, path)
    keys = view.select("view_key").distinct()
    return scan_view(read_view(spark, path), keys).select("view_key", "k0", "k1", "doc_id")


@query
def view_scan(spark, sf_dir):
    """Scan with document lookup; a document the store lacks is null."""
    keys = plan_keys(spark, TEXT_SPEC).select("view_key", "key_ord")
    rows = scan_view(t.text_view(spark, sf_dir), keys, t.text_store(spark, sf_dir))
    return rows.select("key_ord", "view_key", "doc_id", "emitted", "value")


@query
def view_scan_by_table(spark, sf_dir):
    """Keys from a table: the months in which customers of one segment ordered."""
    docs = t.load(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey")).alias("doc_id"),
        F.date_format("o_orderdate", "yyyyMM").alias("month"),
        F.col("o_orderpriority").alias("value"),
        "o_custkey",
    )
    view = define_view(docs, [F.col("month")], json_only=False, include_docs=True)
    customers = t.load(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'")
    wanted = docs.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    specs = wanted.groupBy("month").count().select(
        F.concat(F.lit('[ "'), "month", F.lit('" ]')).alias("spec"), F.col("count").alias("n_orders")
    )
    keys = expand_keys(specs, "spec").select("view_key", "n_orders")
    return scan_view(view, keys).groupBy("view_key").agg(
        F.first("n_orders").alias("n_orders"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min("doc_id").alias("first_doc"),
        F.max("value").alias("last_value"),
    )


@query
def view_pages(spark, sf_dir):
    keys = plan_keys(spark, TEXT_SPEC).select("view_key", "key_ord")
    rows = scan_view(t.text_view(spark, sf_dir), keys)
    return page_rows(rows, 50).select("key_ord", "doc_id", "page_in_key", "page_no")


@query
def view_page_lines(spark, sf_dir):
    keys = plan_keys(spark, TEXT_SPEC).select("view_key", "key_ord")
    pages = page_rows(scan_view(t.text_view(spark, sf_dir), keys), 50)
    store = t.text_store(spark, sf_dir).select("doc_id", "value")
    return page_lines(pages.join(store, "doc_id"))


@query
def import_profile(spark, sf_dir):
    keys = plan_keys(spark, '["202401((01-31))",0];["202402((01-29))",1]', num_chunks=4)
    rows = scan_view(t.click_view(spark, sf_dir, 2), keys.select("view_key", "chunk_id"))
    return metrics.import_profile(rows, keys)


@query
def json_documents(spark, sf_dir):
    docs = t.event_docs(spark, sf_dir).union(t.text_docs(spark, sf_dir).select("doc_id", "value"))
    return docs.groupBy(F.expr(is_json_sql("value")).alias("is_json")).agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")
    )


# --- text and cells ----------------------------------------------------------------------------------


@query
def text_lines(spark, sf_dir):
    return kv_lines(t.text_docs(spark, sf_dir))


@query
def text_lines_plain(spark, sf_dir):
    return kv_lines(t.text_docs(spark, sf_dir), separator="|", escape=False)


@query
def text_lines_parsed(spark, sf_dir):
    return parse_kv_lines(kv_lines(t.text_docs(spark, sf_dir)))


@query
def cells(spark, sf_dir):
    """Cells by text: copies of a text are puts to one row key, and the one with the highest ID stays."""
    docs = t.load(spark, sf_dir, "documents")
    rows = docs.select(F.col("text").alias("doc_id"), F.col("source").alias("value"), F.col("doc_id").alias("put"))
    made = to_cells(rows, "d", "source", order="put")
    return made.select(F.hex("row_key").alias("row_key"), "family", "qualifier", F.hex("value").alias("value"))


@query
def cells_loaded(spark, sf_dir):
    """Cells of all pages by host and page, loaded first; then a second load that puts the titles of some hosts anew."""
    pages = t.load(spark, sf_dir, "pages")
    root = scratch_dir(spark, "cells")
    first = pages.select(F.col("url").alias("doc_id"), F.md5("html").alias("value"), F.col("page_id").alias("put"))
    load_cells(to_cells(first, "d", "digest", order="put"), root, ranges=16)
    later = t.load(spark, sf_dir, "documents").select(
        F.concat(F.lit("https://"), "source").alias("doc_id"), F.col("lang").alias("value"), F.col("doc_id").alias("put")
    )
    again = pages.select("url", F.lit("seen").alias("value"), F.col("page_id").alias("put")).where("html LIKE '%<article%'")
    more = later.unionByName(again.withColumnRenamed("url", "doc_id"))
    load_cells(to_cells(more, "d", "digest", order="put"), root)
    made = read_loaded_cells(spark, root)
    return made.select(F.hex("row_key").alias("row_key"), "family", "qualifier", F.hex("value").alias("value"))


# --- lines as actions --------------------------------------------------------------------------------


@query
def parse_lines(spark, sf_dir):
    return parse_action_lines(t.order_lines(spark, sf_dir), "ADD", 3600).actions


@query
def parse_lines_unary(spark, sf_dir):
    return parse_action_lines(t.order_lines(spark, sf_dir), "DELETE").actions


@query
def line_rejects(spark, sf_dir):
    lines = t.order_lines(spark, sf_dir)

    def counted(op: str) -> DataFrame:
        counters = metrics.reject_counters(parse_action_lines(lines, op).rejects)
        return counters.select(F.lit(op).alias("op"), "counter", "value")

    return reduce(DataFrame.union, [counted(op) for op in ("SET", "DELETE", "TOUCH", "APPEND")])


@query
def action_builders(spark, sf_dir):
    value, seconds = F.col("props"), (F.col("user_id") % 100).cast("int")
    made = [
        A.set_(value, seconds),
        A.add(value, seconds),
        A.replace(value, seconds),
        A.append(value),
        A.prepend(value),
        A.delete(),
        A.touch(seconds),
        A.exists(),
        A.none(),
    ]
    chosen = F.element_at(F.array(*made), (F.col("event_id") % len(made)).cast("int") + 1)
    return t.load(spark, sf_dir, "events").select("event_id", chosen.alias("a")).select("event_id", "a.*")


# --- mutations ---------------------------------------------------------------------------------------


def uniform(spark: SparkSession, sf_dir: str, op: str) -> ApplyResult:
    feed = t.action_feed(spark, sf_dir).select("doc_id", "seq", "value")
    return apply_operation(t.profile_store(spark, sf_dir), feed, op, t.AS_OF, expiry=60)


def _operation_query(op: str) -> None:
    QUERIES[f"apply_{op.lower()}"] = lambda spark, sf_dir: t.store_rows(uniform(spark, sf_dir, op).store)


for _op in A.OPERATIONS:
    _operation_query(_op)


@query
def operation_outcomes(spark, sf_dir):
    """Outcomes of the whole feed under each single operation."""
    results = [uniform(spark, sf_dir, op).outcomes for op in A.OPERATIONS if op != A.EXISTS]
    return reduce(DataFrame.union, results)


def mixed(spark: SparkSession, sf_dir: str) -> ApplyResult:
    return apply_actions(t.profile_store(spark, sf_dir), t.action_feed(spark, sf_dir), t.AS_OF)


@query
def apply_mixed(spark, sf_dir):
    return t.store_rows(mixed(spark, sf_dir).store)


@query
def apply_changes(spark, sf_dir):
    """Only the documents that the feed changes, and the keys it deletes."""
    return mixed(spark, sf_dir).changes.select(
        "doc_id", "value", F.unix_seconds("expires_at").alias("expires_epoch"), "deleted"
    )


@query
def mixed_outcomes(spark, sf_dir):
    return mixed(spark, sf_dir).outcomes


@query
def outcome_counters(spark, sf_dir):
    return metrics.outcome_counters(mixed(spark, sf_dir).outcomes)


@query
def apply_dialogue(spark, sf_dir):
    """Conversation turns appended in order to the documents of their conversation."""
    turns = t.load(spark, sf_dir, "conversations")
    key = F.concat(F.lit("c"), F.col("conv_id"))
    store = turns.select("conv_id").distinct().select(
        key.alias("doc_id"), F.lit("").alias("value"), F.lit(None).cast("timestamp").alias("expires_at")
    )
    feed = turns.select(
        key.alias("doc_id"),
        F.col("turn").alias("seq"),
        A.append(F.concat("role", F.lit(": "), "text", F.lit("\n"))).alias("a"),
    ).select("doc_id", "seq", "a.*")
    return feed.transform(apply_to(store, t.AS_OF)).select("doc_id", "value")


@query
def expiry_live(spark, sf_dir):
    return t.store_rows(live_documents(t.order_store(spark, sf_dir), "2024-01-01T02:00:00"))


@query
def key_existence_split(spark, sf_dir):
    feed = t.action_feed(spark, sf_dir)
    return existence_counts(key_existence(feed, t.profile_store(spark, sf_dir), t.AS_OF))


@query
def existing_feed_rows(spark, sf_dir):
    """Actions whose key has a live profile."""
    feed = t.action_feed(spark, sf_dir).select("doc_id", "seq", "op")
    return existing_keys(feed, t.profile_store(spark, sf_dir), t.AS_OF)


@query
def missing_feed_rows(spark, sf_dir):
    """Actions whose key has none."""
    feed = t.action_feed(spark, sf_dir).select("doc_id", "seq", "op")
    return missing_keys(feed, t.profile_store(spark, sf_dir), t.AS_OF)


# --- updates -----------------------------------------------------------------------------------------


def _purchases(events: DataFrame) -> DataFrame:
    key = F.when(F.col("event_type") == "purchase", F.expr(t.USER_KEY))
    return events.select(key.alias("doc_id"), "event_id", "props")


def _totals(payload, existing):
    text = F.concat(F.lit("n="), payload["n"], F.lit(",last="), payload["last"])
    return F.when(existing.isNull(), A.add(text, 60)).otherwise(A.replace(F.concat(existing, F.lit("|"), text), 90))


@query
def update_profiles(spark, sf_dir):
    """Purchases counted per user and written into new or existing profiles."""
    result = update_documents(
        t.profile_store(spark, sf_dir),
        t.load(spark, sf_dir, "events"),
        _totals,
        t.AS_OF,
        transform=_purchases,
        reduce=[F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last")],
    )
    return t.store_rows(result.store)


def _in_order(payload, existing):
    text = F.concat(F.lit("v"), payload["event_id"], F.lit(";"))
    kind = payload["event_type"]
    return (
        F.when(existing.isNull() & (kind == "error"), A.none())
        .when(existing.isNull(), A.add(text, 60))
        .when(kind == "error", A.delete())
        .when(F.length(existing) > 40, A.replace(text))
        .otherwise(A.append(text))
    )


def _sequential(spark, sf_dir):
    source = t.load(spark, sf_dir, "events").select(
        F.expr(t.USER_KEY).alias("doc_id"), "event_id", "event_type"
    )
    return update_documents(t.profile_store(spark, sf_dir), source, _in_order, t.AS_OF, order_by="event_id")


@query
def update_sequential(spark, sf_dir):
    """Events merged one after the other, each seeing what the one before wrote."""
    return t.store_rows(_sequential(spark, sf_dir).store)


def _in_order_by_hand(payload: dict, existing: str | None) -> tuple[str, str | None, int] | None:
    text = f"v{payload['event_id']};"
    failed = payload["event_type"] == "error"
    if existing is None:
        return None if failed else (A.ADD, text, 60)
    if failed:
        return A.DELETE, None, 0
    return (A.REPLACE if len(existing) > 40 else A.APPEND), text, 0


@query
def update_python_merge(spark, sf_dir):
    """The same merge as a Python function, streamed in key order."""
    source = t.load(spark, sf_dir, "events").select(F.expr(t.USER_KEY).alias("doc_id"), "event_id", "event_type")
    profiles = t.profile_store(spark, sf_dir)
    return t.store_rows(update_in_order(profiles, source, _in_order_by_hand, t.AS_OF, order_by="event_id").store)


def _composed(spark, sf_dir):
    def merge(payload, existing):
        text = F.concat(F.lit("v"), payload["event_id"], F.lit(";"))
        kind = payload["event_type"]
        return (
            F.when(existing.isNull() & (kind == "error"), A.none())
            .when(existing.isNull(), A.add(text, 60))
            .when(kind == "error", A.delete())
            .when(kind == "purchase", A.replace(F.concat(F.lit("p"), existing, F.lit("|"), text), 90))
            .otherwise(A.append(text))
        )

    source = t.load(spark, sf_dir, "events").select(F.expr(t.USER_KEY).alias("doc_id"), "event_id", "event_type")
    return update_composed(t.profile_store(spark, sf_dir), source, merge, t.AS_OF, order_by="event_id", max_group_rows=16)


@query
def update_in_one_pass(spark, sf_dir):
    """Events merged in order by a merge that can be composed, oversized keys in segments."""
    return t.store_rows(_composed(spark, sf_dir).store)


@query
def update_in_one_pass_summary(spark, sf_dir):
    return _composed(spark, sf_dir).summary


@query
def update_summary(spark, sf_dir):
    return _sequential(spark, sf_dir).summary


@query
def lookup_merge(spark, sf_dir):
    """Labels merged row by row with stored documents; half of the keys are no document's."""
    labels = t.load(spark, sf_dir, "labels").select(
        (F.col("doc_id") * 2).cast("string").alias("doc_id"), F.col("doc_id").alias("seq"), "quality", "toxic"
    )

    def merge(payload, existing):
        label = F.concat(F.lit("q"), payload["quality"])
        return F.when(existing.isNull(), A.none()).when(payload["toxic"] == 1, A.delete()).otherwise(
            A.replace(F.concat(existing, label))
        )

    return merge_actions(labels, t.text_store(spark, sf_dir), merge, t.AS_OF)


@query
def batch_stats(spark, sf_dir):
    return metrics.batch_counters(t.load(spark, sf_dir, "events"), "event_type", 128)


@query
def batches(spark, sf_dir):
    events = assign_batches(t.load(spark, sf_dir, "events"), "event_type", "event_id", 128)
    return events.groupBy("event_type", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


# --- retries and gates -------------------------------------------------------------------------------


class FlakyClient:
    """A client whose answers depend only on the action: the number in its value decides how often it
    fails at first and whether it ends in success."""

    def __init__(self):
        self.seen: dict[str, int] = {}

    def store(self, op, key, value, expiry):
        number = int(value[1:-1])
        tried = self.seen.get(value, 0)
        self.seen[value] = tried + 1
        if tried < number % 4:
            return metrics.TEMPORARY_FAILURE
        if number % 10 == 7:
            raise TimeoutError
        return "Data exists for key" if number % 10 == 3 else metrics.SUCCESS

    def close(self):
        self.seen.clear()


def _no_sleep(seconds: float) -> None:
    pass


def _attempts(spark, sf_dir):
    feed = t.action_feed(spark, sf_dir)
    return push_attempts(
        feed, FlakyClient, max_tries=2, max_wait_ms=1, max_total_wait_ms=2**31, sleep=_no_sleep
    )


@query
def push_log(spark, sf_dir):
    return _attempts(spark, sf_dir)


@query
def push_resumable_log(spark, sf_dir):
    """The attempt log of a push that keeps it while it goes on."""
    feed = t.action_feed(spark, sf_dir)
    options = {"max_tries": 2, "max_wait_ms": 1, "max_total_wait_ms": 2**31, "sleep": _no_sleep}
    return push_resumable(feed, FlakyClient, scratch_dir(spark, "push"), ordered=True, **options)


class EvenProfiles:
    """A store outside, in which every second user of the feed has a document."""

    def get_many(self, keys):
        return {k: f"profile of {k}" for k in keys if int(k[1:]) % 40 == 0}

    def close(self):
        pass


@query
def fetched_documents(spark, sf_dir):
    """Documents of the events' users fetched in calls of at most 16 keys, and how many each user's events need."""
    events = t.load(spark, sf_dir, "events").select(F.expr(t.USER_KEY).alias("doc_id"), "event_id")
    fetched = fetch_documents(events, EvenProfiles, scratch_dir(spark, "fetched"), batch_size=16)
    return with_existing(events, fetched)


@query
def update_outside_log(spark, sf_dir):
    """Events merged with documents fetched from outside and pushed back: the log of the push."""

    def merge(payload, existing):
        text = F.concat(F.lit("v"), payload["event_id"], F.lit(";"))
        return F.when(existing.isNull(), A.add(text)).otherwise(A.append(text))

    report = jobs.update_outside(
        t.load(spark, sf_dir, "events"),
        EvenProfiles,
        FlakyClient,
        merge,
        scratch_dir(spark, "outside"),
        transform=lambda events: events.select(F.expr(t.USER_KEY).alias("doc_id"), "event_id"),
        seq="event_id",
        batch_size=16,
        max_tries=2,
        max_wait_ms=1,
        max_total_wait_ms=2**31,
        sleep=_no_sleep,
    )
    return report.attempts


@query
def attempt_profile(spark, sf_dir):
    attempts = _attempts(spark, sf_dir)
    counters = metrics.attempt_counters(attempts).union(metrics.retry_profile(attempts))
    return counters.union(metrics.failed_records(attempts))


@query
def backoff_waits(spark, sf_dir):
    waits = backoff_schedule(F.col("event_id") % 18, 1000)
    return t.load(spark, sf_dir, "events").select(
        "event_id",
        F.array_join(waits.cast("array<string>"), ",").alias("waits"),
        F.aggregate(waits, F.lit(0).cast("bigint"), lambda a, w: a + w).alias("total_wait"),
    )


@query
def failed_shares(spark, sf_dir):
    outcomes = mixed(spark, sf_dir).outcomes.withColumn("chunk_id", F.col("seq") % 20)
    shares = failed_share(outcomes, "chunk_id", F.col("outcome").isin("exists", "missing"))
    return shares.withColumn("failed_share", F.round("failed_share", 9))


# --- jobs: written to files and read back --------------------------------------------------------------


@query
def job_import(spark, sf_dir):
    path = scratch_dir(spark, "import")
    jobs.import_view(t.text_view(spark, sf_dir), TEXT_SPEC, path, t.text_store(spark, sf_dir))
    return read_kv_text(spark, path)


LONG_SPEC = '["2024((0001-1231))", 0];["2024((0001-1231))",1];["20240115",((0-2))]'


@query
def import_long_range(spark, sf_dir):
    """A stored view read by a spec of more keys than become literals: its ranges say which folders are read."""
    path, out = scratch_dir(spark, "view"), scratch_dir(spark, "import")
    write_view(t.click_view(spark, sf_dir, 2, include_docs=True), path)
    jobs.import_view(read_view(spark, path), LONG_SPEC, out, num_chunks=8, by_chunk=True)
    return read_kv_text(spark, out)


@query
def job_import_cells(spark, sf_dir):
    path = scratch_dir(spark, "cells")
    jobs.import_view_to_cells(t.text_view(spark, sf_dir), TEXT_SPEC, path, "d", "text", t.text_store(spark, sf_dir))
    made = read_cells(spark, path)
    return made.select(F.hex("row_key").alias("row_key"), "family", "qualifier", F.hex("value").alias("value"))


@query
def job_import_paged(spark, sf_dir):
    path = scratch_dir(spark, "paged")
    jobs.import_view_paged(t.text_view(spark, sf_dir), TEXT_SPEC, path, t.text_store(spark, sf_dir), page_size=50)
    lines = spark.read.text(path).select("page", "value")
    return lines.groupBy("page").agg(F.count(F.lit(1)).alias("n_lines"), F.max("value").alias("last_line"))


@query
def job_import_page_files(spark, sf_dir):
    """The same pages as one file each, in one folder."""
    path = scratch_dir(spark, "paged")
    view, store = t.text_view(spark, sf_dir), t.text_store(spark, sf_dir)
    jobs.import_view_paged(view, TEXT_SPEC, path, store, page_size=50, flat=True)
    lines = spark.read.text(path).select(F.regexp_extract(F.input_file_name(), "[^/]+$", 0).alias("page"), "value")
    return lines.groupBy("page").agg(F.count(F.lit(1)).alias("n_lines"), F.max("value").alias("last_line"))


@query
def job_export(spark, sf_dir):
    """Lines written to files, exported into a stored document store, and the new store read back."""
    root, lines = scratch_dir(spark, "store"), scratch_dir(spark, "lines")
    write_snapshot(t.order_store(spark, sf_dir), root)
    t.order_lines(spark, sf_dir).select("line").write.text(lines)
    jobs.export_lines(spark, lines, root, t.AS_OF, op="ADD", expiry=60)
    return t.store_rows(current_store(spark, root))


@query
def job_export_counters(spark, sf_dir):
    root, lines = scratch_dir(spark, "store"), scratch_dir(spark, "lines")
    write_snapshot(t.order_store(spark, sf_dir), root)
    t.order_lines(spark, sf_dir).select("line").write.text(lines)
    return jobs.export_lines(spark, lines, root, t.AS_OF, op="REPLACE").counters


@query
def job_update(spark, sf_dir):
    root = scratch_dir(spark, "store")
    write_snapshot(t.profile_store(spark, sf_dir), root)
    jobs.update_job(
        t.load(spark, sf_dir, "events"),
        root,
        _totals,
        t.AS_OF,
        transform=_purchases,
        reduce=[F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last")],
    )
    return t.store_rows(current_store(spark, root))


@query
def job_save_actions(spark, sf_dir):
    root = scratch_dir(spark, "store")
    write_snapshot(t.profile_store(spark, sf_dir), root)
    save_actions(t.action_feed(spark, sf_dir), root, t.AS_OF)
    return t.store_rows(current_store(spark, root))


# --- larger feeds ------------------------------------------------------------------------------------


@query
def apply_line_feed(spark, sf_dir):
    """The last line of each order becomes its document."""
    result = apply_operation(t.large_store(spark, sf_dir), t.line_feed(spark, sf_dir), A.SET, t.AS_OF)
    return t.store_rows(result.store)


@query
def apply_line_feed_mixed(spark, sf_dir):
    """Order lines as mixed actions: the line number decides the operation."""
    op = F.element_at(F.array(*[F.lit(o) for o in A.OPERATIONS]), F.col("number") % 9 + 1)
    feed = t.line_feed(spark, sf_dir).select("doc_id", "seq", op.alias("op"), "value", F.lit(0).alias("expiry"))
    result = apply_actions(t.large_store(spark, sf_dir), feed, t.AS_OF)
    return t.store_rows(result.store)


# --- stores in buckets, and views that follow them -----------------------------------------------------


def _in_buckets(spark: SparkSession, store: DataFrame, buckets: int) -> str:
    root = scratch_dir(spark, "buckets")
    create_buckets(store, root, buckets)
    return root


@query
def store_buckets_apply(spark, sf_dir):
    """The mixed feed saved into profiles kept in buckets."""
    root = _in_buckets(spark, t.profile_store(spark, sf_dir), 32)
    save_actions(t.action_feed(spark, sf_dir), root, t.AS_OF)
    return t.store_rows(current_store(spark, root))


@query
def store_buckets_export(spark, sf_dir):
    """Lines exported into orders kept in buckets."""
    root, lines = _in_buckets(spark, t.order_store(spark, sf_dir), 16), scratch_dir(spark, "lines")
    t.order_lines(spark, sf_dir).select("line").write.text(lines)
    jobs.export_lines(spark, lines, root, t.AS_OF, op="ADD", expiry=60)
    return t.store_rows(current_store(spark, root))


@query
def store_buckets_update(spark, sf_dir):
    root = _in_buckets(spark, t.profile_store(spark, sf_dir), 16)
    jobs.update_job(
        t.load(spark, sf_dir, "events"),
        root,
        _totals,
        t.AS_OF,
        transform=_purchases,
        reduce=[F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last")],
    )
    return t.store_rows(current_store(spark, root))


@query
def store_snapshots_shared(spark, sf_dir):
    """Both versions of a store of orders, before and after the orders of the richest customers were deleted."""
    root = _in_buckets(spark, t.large_store(spark, sf_dir), 64)
    rich = t.load(spark, sf_dir, "customer").where("c_acctbal > 9900").select(F.col("c_custkey").alias("o_custkey"))
    orders = t.load(spark, sf_dir, "orders").join(rich, "o_custkey", "left_semi")
    feed = orders.select(F.concat(F.lit("o"), "o_orderkey").alias("doc_id"), F.col("o_orderkey").alias("seq"), A.delete().alias("a"))
    save_actions(feed.select("doc_id", "seq", "a.*"), root, t.AS_OF)
    both = [read_buckets(spark, root, version).select(F.lit(version).alias("version"), "doc_id", "value") for version in (1, 2)]
    return both[0].union(both[1])


@query
def store_lookup(spark, sf_dir):
    """The documents of each customer's last order, looked up by ID in the store's buckets."""
    root = _in_buckets(spark, t.large_store(spark, sf_dir), 64)
    last = t.load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("last"))
    ids = last.select(F.concat(F.lit("o"), "last").alias("doc_id"))
    return documents_by_id(spark, root, ids).select("doc_id", "value")


def _profile_view(docs: DataFrame) -> DataFrame:
    return define_view(docs, [F.length("value") % 7], json_only=False, emitted=F.substring("value", 1, 4))


def _followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, view = _in_buckets(spark, t.profile_store(spark, sf_dir), 32), scratch_dir(spark, "followed")
    create_view(spark, view, root, _profile_view)
    feed = t.action_feed(spark, sf_dir)
    middle = feed.agg(F.percentile_approx("seq", 0.5)).first()[0]
    for part in (feed.where(F.col("seq") <= middle), feed.where(F.col("seq") > middle)):
        save_actions(part, root, t.AS_OF, views={view: _profile_view})
    return read_followed(spark, view)


@query
def view_after_changes(spark, sf_dir):
    """A view that has followed its store through both halves of a feed."""
    return _followed(spark, sf_dir)


@query
def followed_view_scan(spark, sf_dir):
    keys = plan_keys(spark, "[((0-3))];[5];[5];[9]").select("view_key", "key_ord")
    return scan_view(_followed(spark, sf_dir), keys).select("key_ord", "doc_id", "emitted")
