"""Stored tables: document-store snapshots, partitioned views and shared scratch tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators.views import key_parts
from docloom.schemas import STORE, conform

_SNAPSHOT = re.compile(r"snapshot-(\d{8})")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``, or under the checkpoint folder set in code."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", *, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: its lineage ends there.

    Unlike cached blocks the files outlive lost executors, and later passes read only the columns they
    need.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, fs = hadoop_path(spark, path)
    return fs.exists(found)


def stored_whole(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written to ``path`` to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def _snapshot_folders(spark: SparkSession, root: str) -> dict[int, bool]:
    """Number of every snapshot folder, and whether the snapshot is complete."""
    path, fs = hadoop_path(spark, root)
    if not fs.exists(path):
        return {}
    found = {}
    for status in fs.listStatus(path):
        match = _SNAPSHOT.fullmatch(status.getPath().getName())
        if match:
            found[int(match.group(1))] = fs.exists(hadoop_path(spark, f"{status.getPath().toString()}/_SUCCESS")[0])
    return found


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete snapshots of a store, ascending."""
    return sorted(n for n, complete in _snapshot_folders(spark, root).items() if complete)


def write_snapshot(store: DataFrame, root: str) -> int:
    """Write a store as the next snapshot under ``root`` and return its number.

    A snapshot counts only once Spark has put its success marker, so readers never see half a store and
    the snapshot the new one was computed from is never touched. The number of a write that broke off is
    not used again.
    """
    spark = store.sparkSession
    version = max(_snapshot_folders(spark, root), default=0) + 1
    conform(store, STORE).write.mode("errorifexists").parquet(f"{root.rstrip('/')}/snapshot-{version:08d}")
    return version


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Read one snapshot, by default the newest complete one."""
    versions = snapshot_versions(spark, root)
    if version is None:
        if not versions:
            raise FileNotFoundError(f"no complete snapshot under {root}")
        version = versions[-1]
    elif version not in versions:
        raise FileNotFoundError(f"no complete snapshot {version} under {root}")
    return spark.read.schema(STORE).parquet(f"{root.rstrip('/')}/snapshot-{version:08d}")


def save_bucketed_store(store: DataFrame, table: str, buckets: int, *, mode: str = "errorifexists") -> None:
    """Save a store as a catalog table bucketed by ``doc_id``.

    Applying actions to such a table shuffles the actions only: the documents are joined where they are.
    """
    conform(store, STORE).write.mode(mode).bucketBy(buckets, "doc_id").sortBy("doc_id").saveAsTable(table)


def write_view(view: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Store a view, partitioned by its key parts if it has them.

    A folder name can be neither empty nor null, so a part is stored with a letter before it. The rows are brought together by partition, and by document within it, so that a partition is written
    in few files yet a large one is spread over many tasks.
    """
    parts = key_parts(view)
    if not parts:
        view.write.mode(mode).parquet(path)
        return
    named = {p: F.when(F.col(p).isNull(), "n").otherwise(F.concat(F.lit("v"), p)) for p in parts}
    view = view.withColumns(named)
    view.repartitionByRange(*parts, "doc_id").write.mode(mode).partitionBy(*parts).parquet(path)


def read_view(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a stored view; key parts stay text (no type guessing that would drop leading zeros).

    A known ``schema`` saves a look at the files, and reads a view that was written without rows.
    """
    found = spark.read.parquet(path).schema if schema is None else schema
    parts_last = sorted(found.fields, key=lambda f: _is_part(f.name))
    read = T.StructType([T.StructField(f.name, T.StringType() if _is_part(f.name) else f.dataType) for f in parts_last])
    view = spark.read.schema(read).parquet(path)
    parts = [f.name for f in read if _is_part(f.name)]
    return view.withColumns({p: F.when(F.col(p) != "n", F.substring(p, 2, 1 << 30)) for p in parts})


def _is_part(name: str) -> bool:
    return name[:1] == "k" and name[1:].isdigit()
