"""What the operators share: stored tables, a global order with prefix sums, and connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A row number inside a partition takes the lower bits of ``at``, the partition's number the upper ones.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines see; a session on one machine that names none, as in tests, gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="docloom-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: fixed rows, short lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(stored_table: DataFrame) -> None:
    """Remove the files of a stored table that nothing reads any more."""
    jvm = stored_table.sparkSession._jvm
    conf = stored_table.sparkSession._jsc.hadoopConfiguration()
    for folder in {name.rpartition("/")[0] for name in stored_table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def with_columns(row: str, df: DataFrame, **new: Column) -> DataFrame:
    """The fields of struct column ``row`` followed by new columns; a field of a new column's name gives way to it."""
    taken = {name.lower() for name in new}
    kept = [f.name for f in df.schema[row].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col(row)[name].alias(name) for name in kept], *[c.alias(name) for name, c in new.items()])


def in_order(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """
    ``df`` in one global order of ``keys``, stored, with ``at``: partition and row number in one long that grows along it.

    Rows that agree in all keys are split between partitions like any others, so no key makes a large partition.
    """
    df = df.withColumn("tie", F.monotonically_increasing_id())
    keys = [*keys, "tie"]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    return stored(placed.withColumn("at", F.monotonically_increasing_id()), name)


def block() -> Column:
    return F.shiftrightunsigned("at", _ROW_BITS)


def row_in_block() -> Column:
    return F.col("at").bitwiseAND(F.lit(_ROW_MASK))


def block_starts(placed: DataFrame) -> DataFrame:
    """``block, first_row``: rows before each partition of a table from ``in_order``; one row per partition."""
    counts = placed.groupBy(block().alias("block")).agg(F.count("*").alias("n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_row"))


def with_row_number(placed: DataFrame, name: str) -> DataFrame:
    """Adds the 0-based place in the global order: the row's number in its partition behind the partitions before it."""
    starts = F.broadcast(block_starts(placed).withColumnRenamed("block", "of_block"))
    return placed.join(starts, block() == F.col("of_block")).withColumn(name, F.col("first_row") + row_in_block()).drop(
        "of_block", "first_row"
    )


def with_totals_before(placed: DataFrame, values: dict[str, Column], group: str | None = None) -> DataFrame:
    """
    Adds for each of ``values`` its sum over the rows before this one, of the same group if one is given.

    A running sum inside each partition, plus what came before the partition. With a group, the table must be ordered
    by it first; then at most one group comes into a partition from the one before, so the carried sums are at most one
    row per partition and safe to broadcast.
    """
    parts = [group] if group else []
    blocks = placed.withColumn("in_block", block())
    local = Window.partitionBy(*parts, "in_block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy(*parts, "in_block").agg(*[F.sum(v).alias(f"sum_{n}") for n, v in values.items()])
    across = Window.partitionBy(*parts).orderBy("in_block")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        F.col("in_block").alias("of_block"),
        *[F.col(group).alias("of_group") for _ in parts],
        F.lag("in_block").over(across).alias("previous"),
        *[F.sum(f"sum_{n}").over(earlier).alias(f"carried_{n}") for n in values],
    ).where("previous IS NOT NULL")
    on = F.col("in_block") == F.col("of_block")
    if group:
        on = on & F.col(group).eqNullSafe(F.col("of_group"))
    within = blocks.select("*", *[F.coalesce(F.sum(v).over(local), F.lit(0)).alias(f"local_{n}") for n, v in values.items()])
    joined = within.join(F.broadcast(carried), on, "left")
    totals = {n: F.col(f"local_{n}") + F.coalesce(f"carried_{n}", F.lit(0)) for n in values}
    return joined.select(*placed.columns, *[c.alias(n) for n, c in totals.items()])


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """
    ``id, root`` for every id of ``links(a, b)``: root is the smallest id that links lead to.

    Alternating star contraction: every neighbour of a node above (then below) it is tied to the smallest neighbour,
    until nothing changes. Each round is stored; a node with many neighbours is only ever grouped by a minimum.
    """
    first = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    edges, seen = stored(first, name), None
    state = F.struct(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")))
    while (now := edges.agg(state.alias("s")).first().s) != seen:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("of")).agg(F.min("lo").alias("m")).select("of", F.least("of", "m").alias("m"))
        # Large star: neighbours above a node go to its smallest neighbour.
        large = edges.join(least, F.col("lo") == F.col("of")).select("hi", F.col("m").alias("lo"))
        # Small star: a node's neighbours below it go to the smallest of them, and so does the node.
        low = large.groupBy(F.col("hi").alias("of")).agg(F.min("lo").alias("m"))
        small = large.join(low, F.col("hi") == F.col("of"))
        small = small.select("lo", "m").where("lo <> m").unionByName(small.select(F.col("hi").alias("lo"), "m"))
        after = stored(small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct(), name)
        dropped(edges)
        edges, seen = after, now
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("root"))


def fold_key() -> str:
    """SQL of the fold that held-out rows are told by: crc32 of the id's text, modulo 4."""
    return "crc32(cast(cast(doc_id AS string) AS binary)) % 4"
