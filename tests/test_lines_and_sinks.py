import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import AS_OF
from docloom.functions import actions as A
from docloom.functions.expiry import backoff_schedule
from docloom.operators.gate import FailedShareExceeded, failed_share, require_failed_share
from docloom.operators.metrics import attempt_counters, failed_records, retry_profile
from docloom.plans.jobs import export_lines, update_job
from docloom.schemas import ACTIONS, STORE, conform
from docloom.sinks.push import push_actions, push_attempts
from docloom.sinks.store import current_store, save_actions
from docloom.sinks.text import kv_lines, parse_kv_lines, write_page_files
from docloom.sources.lines import parse_action_lines, read_lines
from docloom.sources.tables import read_snapshot, snapshot_versions, write_snapshot


def parsed(spark, lines, op, **options):
    df = spark.createDataFrame([(line, i) for i, line in enumerate(lines)], "line string, seq bigint")
    result = parse_action_lines(df, op, **options)
    return (
        [(r["doc_id"], r["value"]) for r in result.actions.orderBy("seq").collect()],
        [r["line"] for r in result.rejects.collect()],
    )


LINES = ["a\t", "", "\t\t", "k\tv\tz", "\tv", "k\t\tz"]


def test_lines_of_binary_operations(spark):
    assert parsed(spark, LINES, "SET") == ([("k", "v"), ("", "v"), ("k", "")], ["a\t", "", "\t\t"])


@pytest.mark.parametrize("op", ["DELETE", "TOUCH", "EXISTS"])
def test_lines_of_unary_operations(spark, op):
    assert parsed(spark, LINES, op) == (
        [("a", None), ("", None), ("k", "v"), ("", "v"), ("k", "")],
        ["\t\t"],
    )


def test_delimiter_is_a_pattern_unless_literal(spark):
    assert parsed(spark, ["a1b22c"], "SET", delimiter=r"\d+") == ([("a", "b")], [])
    assert parsed(spark, ["a.b|c"], "SET", delimiter=".", literal=True) == ([("a", "b|c")], [])
    assert parsed(spark, ["a,b,c"], "ADD", expiry="3600", delimiter=",") == ([("a", "b")], [])


def test_options_are_checked():
    assert A.parse_operation(None) == "SET" and A.parse_operation("EXISTS") == "TOUCH"
    assert A.parse_expiry(None) == 0 and A.parse_expiry("3600") == 3600
    for bad in ("x", "", -1, "1.5", 2**31):
        with pytest.raises(ValueError):
            A.parse_expiry(bad)
    with pytest.raises(ValueError):
        A.parse_operation("set")


@given(st.lists(st.tuples(st.text(min_size=1, max_size=6), st.text(alphabet="\\tnr\t\n\r x", max_size=12)), min_size=20, max_size=50))
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_escaped_lines_read_back(spark, docs):
    df = spark.createDataFrame(docs, "doc_id string, value string")
    lines = kv_lines(df)
    assert lines.where("value RLIKE '[\\n\\r]'").count() == 0
    assert [tuple(r) for r in parse_kv_lines(lines).collect()] == docs


def test_export_job(spark, tmp_path):
    root, text = str(tmp_path / "store"), tmp_path / "lines"
    text.mkdir()
    (text / "in.csv").write_text("k1,v1\nk2,v2,more\nbad\n,empty\nk1,again\n")
    write_snapshot(spark.createDataFrame([("k2", "old", None)], STORE), root)
    report = export_lines(spark, str(text), root, AS_OF, op="ADD", expiry=3600, delimiter=",")
    assert report.version == 2
    rows = {r["doc_id"]: (r["value"], r["e"]) for r in read_snapshot(spark, root).select("doc_id", "value", F.unix_seconds("expires_at").alias("e")).collect()}
    assert rows == {"k1": ("v1", 1704067200 + 3600), "k2": ("old", None)}
    assert {r["counter"]: r["value"] for r in report.counters.collect()} == {
        "FAILED_STORE_OPERATIONS": 2,
        "EXISTENT_KEYS": 2,
        "NON_EXISTENT_TOUCHED_KEYS": 0,
        "LINES_WITH_WRONG_COLUMNS_COUNT": 1,
    }
    assert sorted(r["outcome"] for r in report.outcomes.collect()) == ["exists", "exists", "invalid_key", "stored"]
    (text / "in.csv").write_text("k1\nk9\n")
    assert export_lines(spark, str(text), root, AS_OF, op="DELETE").version == 3
    assert {r["doc_id"] for r in read_snapshot(spark, root).collect()} == {"k2"}
    assert {r["doc_id"] for r in read_snapshot(spark, root, 2).collect()} == {"k1", "k2"}


def test_line_numbers_follow_the_file(spark, tmp_path):
    (tmp_path / "f").write_text("".join(f"k\t{i}\n" for i in range(100)))
    rows = read_lines(spark, str(tmp_path / "f")).orderBy("seq").collect()
    assert [r["line"] for r in rows] == [f"k\t{i}" for i in range(100)]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "s")
    assert snapshot_versions(spark, root) == [] and current_store(spark, root).count() == 0
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root)
    actions = spark.createDataFrame([("a", 1, "SET", "x", 0)], ACTIONS)
    saved = save_actions(actions, root, AS_OF)
    assert saved.version == 1 and saved.outcomes.first()["outcome"] == "stored"
    os.makedirs(f"{root}/snapshot-00000002")  # a write that never finished
    assert read_snapshot(spark, root).first()["value"] == "x"
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root, 2)
    more = spark.createDataFrame([("b", 1, "SET", "y", 0)], ACTIONS)
    assert save_actions(more, root, AS_OF).version == 3
    assert snapshot_versions(spark, root) == [1, 3] and read_snapshot(spark, root).count() == 2
    with pytest.raises(ValueError):
        conform(actions, STORE)


def test_update_job(spark, tmp_path):
    root = str(tmp_path / "s")
    write_snapshot(spark.createDataFrame([("a", "1", None)], STORE), root)
    source = spark.createDataFrame([("a", "x"), ("b", "y")], "doc_id string, t string")
    report = update_job(source, root, lambda p, old: A.set_(F.concat(F.coalesce(old, F.lit("")), p["t"])), AS_OF)
    assert {r["doc_id"]: r["value"] for r in current_store(spark, root).collect()} == {"a": "1x", "b": "y"}
    assert {r["value"] for r in report.counters.collect()} == {0}


class Flaky:
    """Fails ``n`` times for a value ``n``, forever for ``never``; ``slow`` times out."""

    def __init__(self):
        self.tries = {}

    def store(self, op, key, value, expiry):
        done = self.tries.get(key, 0)
        self.tries[key] = done + 1
        if value == "slow":
            raise TimeoutError
        if value == "taken":
            return "Data exists for key"
        if value == "never" or (value or "").isdigit() and done < int(value):
            return "Temporary failure"
        return "Success"

    def close(self):
        pass


def no_sleep(seconds):
    pass


def test_push_retries_and_counts(spark, tmp_path):
    rows = [("a", 1, "SET", "0", 0), ("b", 2, "SET", "3", 0), ("c", 3, "ADD", "taken", 0), ("d", 4, "SET", "slow", 0),
            ("e", 5, "SET", "never", 0), ("f", 6, "NONE", None, 0), ("g", 7, "EXISTS", None, 5)]
    actions = spark.createDataFrame(rows, ACTIONS)
    log = push_actions(actions, Flaky, str(tmp_path / "log"), max_tries=5, max_wait_ms=4, sleep=no_sleep)
    attempts = {}
    for r in log.orderBy("seq", "try_no").collect():
        attempts.setdefault(r["doc_id"], []).append((r["try_no"], r["status"], r["wait_ms"]))
    busy = "Temporary failure"
    assert attempts["b"] == [(0, busy, 1), (1, busy, 2), (2, busy, 4), (3, "Success", 0)]
    assert attempts["e"] == [(0, busy, 1), (1, busy, 2), (2, busy, 4), (3, busy, 4), (4, busy, 4), (5, busy, 0)]
    assert attempts["d"] == [(0, "Timed out", 0)] and "f" not in attempts and attempts["g"] == [(0, "Success", 0)]
    counters = {r["counter"]: r["value"] for r in attempt_counters(log).union(retry_profile(log)).union(failed_records(log)).collect()}
    assert counters == {
        "FAILED_STORE_OPERATIONS": 11, "EXISTENT_KEYS": 1, "NON_EXISTENT_TOUCHED_KEYS": 0, "TIMEOUT_OPERATIONS": 1,
        "TOTAL_TIMEOUT": 22, "EXP_BACKOFF_COUNT_FOR_TRY_1": 2, "EXP_BACKOFF_COUNT_FOR_TRY_2": 2,
        "EXP_BACKOFF_COUNT_FOR_TRY_3": 2, "EXP_BACKOFF_COUNT_FOR_TRY_4": 1, "EXP_BACKOFF_COUNT_FOR_TRY_5": 1,
        "FAILED_RECORDS": 3,
    }


def test_push_fails_a_task_that_waits_too_long(spark):
    actions = spark.createDataFrame([("e", 5, "SET", "never", 0)], ACTIONS)
    with pytest.raises(Exception, match="allowed 10"):
        push_attempts(actions, Flaky, max_total_wait_ms=10, sleep=no_sleep).collect()


def test_ordered_push_keeps_the_order_of_a_key(spark):
    rows = [(f"k{i % 3}", 100 - i, "SET", "0", 0) for i in range(60)]
    log = push_attempts(spark.createDataFrame(rows, ACTIONS).repartition(4), Flaky, ordered=True, sleep=no_sleep)
    placed = log.select("doc_id", "seq", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at")).collect()
    for key in ("k0", "k1", "k2"):
        mine = sorted((r["at"], r["seq"], r["p"]) for r in placed if r["doc_id"] == key)
        assert [m[1] for m in mine] == sorted(m[1] for m in mine) and len({m[2] for m in mine}) == 1


def test_backoff_schedule(spark):
    row = spark.range(1).select(backoff_schedule(F.lit(12)).alias("w"), backoff_schedule(F.lit(0)).alias("none")).first()
    assert row["w"] == [1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1000, 1000] and row["none"] == []


def test_gate(spark):
    df = spark.range(200).selectExpr("id % 10 AS chunk", "id < 4 AS bad")
    shares = failed_share(df, "chunk", F.col("bad"))
    assert require_failed_share(shares) == pytest.approx(0.02)
    with pytest.raises(FailedShareExceeded):
        require_failed_share(shares, 0.01)
    with pytest.raises(FailedShareExceeded):
        require_failed_share(shares, 0.05, unit="chunk")
    assert require_failed_share(shares.where("false")) == 0.0
    with pytest.raises(ValueError):
        require_failed_share(shares, unit="task")


def test_an_export_counts_rejects_while_it_reads_the_lines(spark, tmp_path):
    lines, root = str(tmp_path / "lines"), str(tmp_path / "store")
    spark.createDataFrame([(x,) for x in (*LINES, "m\tn", "nothing")], "value string").repartition(3).write.text(lines)
    report = export_lines(spark, lines, root, AS_OF, op="SET")
    counters = {r["counter"]: r["value"] for r in report.counters.collect()}
    assert counters["LINES_WITH_WRONG_COLUMNS_COUNT"] == report.rejects.count() == 4
    # The counters come from what the one reading of the lines left, not from the text files.
    plan = report.counters._jdf.queryExecution().toString()
    assert "FileScan text" not in plan and "Scan text" not in plan


def test_page_files_are_flat_and_whole(spark, tmp_path):
    path = str(tmp_path / "pages")
    rows = [(i // 10, f"d{i:03d}", None if 40 <= i < 50 or i == 3 else f"text\n{i}") for i in range(95)]
    pages = spark.createDataFrame(rows, "page_no int, doc_id string, value string").repartition(5)
    assert write_page_files(pages, path) == (10, 84)
    names = sorted(n for n in os.listdir(path) if not n.startswith((".", "_")))
    assert names == [f"part-{i:05d}" for i in range(10)] and "_SUCCESS" in os.listdir(path)
    assert not [n for n in os.listdir(path) if n.startswith(".") and not n.endswith(".crc")]
    lines = open(f"{path}/part-00000").read().split("\n")
    assert lines == [f"d{i:03d}\ttext\\n{i}" for i in range(10) if i != 3] + [""]
    assert open(f"{path}/part-00004").read() == ""
    with pytest.raises(FileExistsError):
        write_page_files(pages, path)
    assert write_page_files(pages.limit(0), str(tmp_path / "none")) == (0, 0)
