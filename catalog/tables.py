"""The test tables read as documents, views, actions and text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions.expiry import as_of_sql, epoch_yyyymmdd, expires_sql, second_of_minute
from docloom.operators.skew import spread
from docloom.operators.views import define_view

AS_OF = "2024-01-01T00:00:00"
CLICK_ID = r"\Aclick::(\w+)::(\d+)\z"


SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with its known schema, so that no job reads file footers first."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a document whose ID holds type, user and time."""
    seconds = "unix_date(cast(ts AS date)) * 86400L + hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
    return load(spark, sf_dir, "events").selectExpr(
        f"concat(event_type, '::u', user_id, '::', {seconds}) AS doc_id", "props AS value"
    )


def click_view(spark: SparkSession, sf_dir: str, partitions: int, *, include_docs: bool = False) -> DataFrame:
    """Clicks by UTC day and a partition number taken from the second."""
    seconds = F.regexp_extract("doc_id", CLICK_ID, 2).cast("bigint")
    return define_view(
        event_docs(spark, sf_dir),
        [epoch_yyyymmdd(seconds), second_of_minute(seconds) % partitions],
        where=F.col("doc_id").rlike(CLICK_ID),
        include_docs=include_docs,
    )


def text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("value"), "lang", "source"
    )


def text_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language and a part of the ID, emitting the source; pages too, which the store lacks."""
    docs = text_docs(spark, sf_dir).withColumn("part", F.col("doc_id").cast("bigint") % 4)
    pages = load(spark, sf_dir, "pages").selectExpr(
        "concat('p', page_id) AS doc_id", "html AS value", "'en' AS lang", "'page' AS source", "page_id % 4 AS part"
    )
    return define_view(
        docs.unionByName(pages),
        [F.col("lang"), F.col("part")],
        json_only=False,
        emitted=F.col("source"),
    )


def text_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, none of which expires."""
    return text_docs(spark, sf_dir).select("doc_id", "value", F.lit(None).cast("timestamp").alias("expires_at"))


def profile_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as user profiles; some expire, some have expired at ``AS_OF``."""
    return load(spark, sf_dir, "customer").selectExpr(
        "concat('u', c_custkey) AS doc_id",
        "c_name AS value",
        """CASE WHEN c_custkey % 6 = 2 THEN timestamp_seconds(1704067200 + c_custkey)
                WHEN c_custkey % 14 = 4 THEN timestamp_seconds(1704067200 - c_custkey) END AS expires_at""",
    )


# Half of these keys lie beyond the profiles.
USER_KEY = "concat('u', user_id * 20)"

FEED_OP = """
  CASE WHEN event_type = 'signup' THEN 'ADD'
       WHEN event_type = 'purchase' THEN if(event_id % 2 = 0, 'SET', 'REPLACE')
       WHEN event_type = 'click' THEN if(event_id % 2 = 0, 'APPEND', 'PREPEND')
       WHEN event_type = 'view' THEN 'TOUCH'
       ELSE if(event_id % 3 = 0, 'NONE', 'DELETE') END"""


def action_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as actions of every kind on user profiles."""
    return load(spark, sf_dir, "events").selectExpr(
        f"{USER_KEY} AS doc_id",
        "event_id AS seq",
        f"{FEED_OP} AS op",
        "concat('v', event_id, ';') AS value",
        "cast(event_id % 5 AS int) AS expiry",
    )


def order_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents with an expiry of some hours, or none."""
    return load(spark, sf_dir, "orders").selectExpr(
        "concat('o', o_orderkey) AS doc_id",
        "concat_ws('/', o_orderstatus, o_orderpriority) AS value",
        f"{expires_sql('o_orderkey % 5 * 3600', as_of_sql(AS_OF))} AS expires_at",
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated lines of every arity: ``(line, seq)``; half of the keys are no order's."""
    key = F.concat(F.lit("o"), F.col("o_orderkey") * 2)
    tab = F.lit("\t")
    line = (
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(key, tab, "o_orderstatus", tab, "o_orderpriority"))
        .when(F.col("o_orderkey") % 7 == 1, F.concat(key, tab))
        .when(F.col("o_orderkey") % 7 == 2, F.lit(""))
        .when(F.col("o_orderkey") % 7 == 3, F.lit("\t\t"))
        .when(F.col("o_orderkey") % 7 == 4, key)
        .when(F.col("o_orderkey") % 7 == 5, F.concat(tab, "o_orderstatus"))
        .otherwise(F.concat(key, tab, tab, "o_orderpriority"))
    )
    return load(spark, sf_dir, "orders").select(line.alias("line"), F.col("o_orderkey").alias("seq"))


def key_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key spec per customer: a padded range, a plain key with a separator in it, a data-driven range."""
    number, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    spec = F.concat(
        F.lit('["c'), number, F.lit('","((00-12))"];"a;'), nation, F.lit('";k(('), nation, F.lit("-"), number % 15,
        F.lit("))"),
    )
    return load(spark, sf_dir, "customer").select(number, spec.alias("spec"))


def store_rows(store: DataFrame) -> DataFrame:
    """A store with its expiry as UNIX seconds, for comparison."""
    return store.select("doc_id", "value", F.unix_seconds("expires_at").alias("expires_epoch"))


def large_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a document without expiry."""
    return load(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey")).alias("doc_id"),
        F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("value"),
        F.lit(None).cast("timestamp").alias("expires_at"),
    )


def line_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as values for the documents of their orders, several per document; ``seq`` is unique."""
    place = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    lines = load(spark, sf_dir, "lineitem")
    return spread(lines, lines.count(), "l_orderkey").select(
        F.concat(F.lit("o"), F.col("l_orderkey")).alias("doc_id"),
        F.row_number().over(place).cast("bigint").alias("seq"),
        F.concat(F.lit("q"), F.col("l_quantity").cast("bigint")).alias("value"),
        F.col("l_linenumber").alias("number"),
    )
