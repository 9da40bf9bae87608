"""A document store cut into buckets by key, of which a feed rewrites only those its keys fall in.

A version lists, for each bucket, the write that holds it. A new version has new folders for the buckets that were
touched and the same ones for all others, so versions share what they have in common and old ones stay readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from typing import Protocol, TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.skew import fits_broadcast
from docloom.schemas import STORE, conform
from docloom.sources.tables import hadoop_path
from docloom.sources.versions import publish, read_version, versions

MAX_LITERAL_IDS = 500
MAX_SCANS = 16  # scans that a lookup of a short list is made of
PAGE_ROWS = 1000  # rows of a Parquet page, the least that a lookup decodes
BROADCAST_BYTES = 64 << 20


class HasStore(Protocol):
    @property
    def store(self) -> DataFrame: ...


Result = TypeVar("Result", bound=HasStore)


def bucket_of(buckets: int) -> Column:
    """The bucket of ``doc_id``."""
    return F.pmod(F.hash("doc_id"), F.lit(buckets))


def is_bucketed(spark: SparkSession, root: str) -> bool:
    return bool(versions(spark, root))


def create_buckets(store: DataFrame, root: str, buckets: int, *, files: int = 1) -> int:
    """Save ``store`` under ``root``, cut into ``buckets`` of ``files`` files each; the first version.

    A bucket is the least that a change rewrites, so there should be many; each costs an entry of a version's list, which
    the driver holds.
    """
    spark = store.sparkSession
    contents = {"buckets": buckets, "files": files, "writes": {}}
    contents["writes"] = _write(store, root, contents)
    return publish(spark, root, 1, contents)


def read_buckets(
    spark: SparkSession, root: str, version: int | None = None, *, only: Iterable[int] | None = None
) -> DataFrame:
    """A version of the store, by default the newest; of the buckets ``only``, if given. No other folder is listed."""
    _, contents = read_version(spark, root, version)
    wanted = None if only is None else set(only)
    return _read(spark, root, {b: w for b, w in contents["writes"].items() if wanted is None or int(b) in wanted})


def touched_buckets(spark: SparkSession, root: str, keys: DataFrame) -> list[int]:
    """Numbers of the buckets that the ``doc_id`` of ``keys`` fall in."""
    _, contents = read_version(spark, root)
    return _touched(keys, contents["buckets"])


def change_buckets(
    spark: SparkSession, root: str, keys: DataFrame, compute: Callable[[DataFrame], Result]
) -> tuple[int, Result]:
    """Bring the store under ``root`` to what ``compute`` makes of it; the new version's number and the result.

    ``compute`` gets the documents of the buckets that ``keys`` fall in and may only change documents of these keys.
    Those buckets are written anew; the others are neither read nor written. A write that breaks off leaves the newest
    version as it was; if another writer was faster, the change raises and can be made again.
    """
    version, contents = read_version(spark, root)
    touched = _touched(keys, contents["buckets"])
    old = contents["writes"]
    result = compute(_read(spark, root, {str(b): old[str(b)] for b in touched if str(b) in old}))
    if not touched:
        return version, result
    kept = {b: w for b, w in old.items() if int(b) not in set(touched)}
    written = _write(result.store, root, contents, tasks=len(touched))
    return publish(spark, root, version + 1, contents | {"writes": kept | written}), result


def documents_by_id(spark: SparkSession, root: str, ids: DataFrame, version: int | None = None) -> DataFrame:
    """The stored documents whose ID occurs in ``ids(doc_id)``: a store to look these IDs up in.

    Only the buckets of the IDs are opened. A short list becomes literals too, by which row groups and pages are skipped:
    files are sorted by ID and carry Bloom filters. A longer list is broadcast if it measures little and else joined by
    shuffle.
    """
    _, contents = read_version(spark, root, version)
    wanted = ids.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    few = [r["doc_id"] for r in wanted.limit(MAX_LITERAL_IDS + 1).collect()]
    if len(few) <= MAX_LITERAL_IDS:
        return _read_listed(spark, root, contents, few)
    found = _read_touched(spark, root, contents, wanted)
    if fits_broadcast(wanted, BROADCAST_BYTES):
        wanted = F.broadcast(wanted)
    return found.join(wanted, "doc_id", "left_semi")


def changed_documents(spark: SparkSession, root: str, since: int, until: int | None = None) -> DataFrame:
    """``(doc_id, before, after)`` of all documents that differ between two versions.

    ``before`` and ``after`` are structs of value and expiry, null where there is no document. Only buckets whose write
    differs are read, however many versions lie between.
    """
    _, old = read_version(spark, root, since)
    _, new = read_version(spark, root, until)
    if old["buckets"] != new["buckets"]:
        sides = [old["writes"], new["writes"]]
    else:
        sides = [{b: w for b, w in x["writes"].items() if y["writes"].get(b) != w} for x, y in ((old, new), (new, old))]
    document = F.struct("value", "expires_at")
    before = _read(spark, root, sides[0]).select("doc_id", document.alias("before"))
    after = _read(spark, root, sides[1]).select("doc_id", document.alias("after"))
    both = before.join(after, "doc_id", "full_outer")
    return both.where(~F.col("before").eqNullSafe(F.col("after")))


def remove_unused(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Keep the newest ``keep`` versions and remove the writes that none of them holds; their names.

    Writes of jobs that broke off go too, so no other writer may be at work.
    """
    found = versions(spark, root)
    for version in found[:-keep]:
        path, fs = hadoop_path(spark, f"{root.rstrip('/')}/versions/{version:08d}.json")
        fs.delete(path, False)
    used = {w for v in found[-keep:] for w in read_version(spark, root, v)[1]["writes"].values()}
    path, fs = hadoop_path(spark, f"{root.rstrip('/')}/data")
    unused = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName() not in used)
    for name in unused:
        fs.delete(hadoop_path(spark, f"{root.rstrip('/')}/data/{name}")[0], True)
    return unused


def _read_listed(spark: SparkSession, root: str, contents: dict, ids: list[str]) -> DataFrame:
    """The documents of a short list, in a few scans, so that each tests its pages against its own buckets' IDs only."""
    listed = spark.createDataFrame([(i,) for i in ids], "doc_id string")
    by_bucket: dict[str, list[str]] = {}
    for r in listed.select("doc_id", bucket_of(contents["buckets"]).alias("bucket")).collect():
        if str(r["bucket"]) in contents["writes"]:
            by_bucket.setdefault(str(r["bucket"]), []).append(r["doc_id"])
    scans = []
    for start in range(min(MAX_SCANS, len(by_bucket))):
        some = sorted(by_bucket)[start::MAX_SCANS]
        own = sorted(i for b in some for i in by_bucket[b])
        found = _read(spark, root, {b: contents["writes"][b] for b in some})
        scans.append(found.where(F.col("doc_id").isin(own) & _one_of(own)))
    return reduce(DataFrame.union, scans) if scans else spark.createDataFrame([], STORE)


def _one_of(ids: list[str]) -> Column:
    """``doc_id`` is one of these, as single comparisons: Parquet tests each against its pages, of an IN list only the range."""
    tests = [F.col("doc_id") == i for i in ids]
    while len(tests) > 1:  # a balanced tree stays shallow
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]


def _touched(keys: DataFrame, buckets: int) -> list[int]:
    valid = keys.where("doc_id IS NOT NULL AND doc_id != ''")
    return sorted(r["bucket"] for r in valid.select(bucket_of(buckets).alias("bucket")).distinct().collect())


def _read_touched(spark: SparkSession, root: str, contents: dict, ids: DataFrame) -> DataFrame:
    touched = _touched(ids, contents["buckets"])
    return _read(spark, root, {str(b): contents["writes"][str(b)] for b in touched if str(b) in contents["writes"]})


def _read(spark: SparkSession, root: str, writes: dict[str, str]) -> DataFrame:
    folders = [f"{root.rstrip('/')}/data/{write}/bucket={b}" for b, write in sorted(writes.items(), key=lambda w: int(w[0]))]
    return spark.read.schema(STORE).parquet(*folders) if folders else spark.createDataFrame([], STORE)


def _write(store: DataFrame, root: str, contents: dict, tasks: int | None = None) -> dict[str, str]:
    """Write documents by bucket, sorted by ID; the buckets that have any, each with this write's name."""
    spark, files, name = store.sparkSession, contents["files"], uuid.uuid4().hex
    folder = f"{root.rstrip('/')}/data/{name}"
    part = F.pmod(F.xxhash64("doc_id"), F.lit(files)).cast("int")
    placed = conform(store, STORE).withColumn("bucket", bucket_of(contents["buckets"]))
    placed = placed.repartition((tasks or contents["buckets"]) * files, "bucket", part).sortWithinPartitions("bucket", "doc_id")
    (
        placed.write.partitionBy("bucket")
        .option("parquet.bloom.filter.enabled#doc_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.block.size", str(16 << 20))
        .option("parquet.page.row.count.limit", str(PAGE_ROWS))
        .parquet(folder)
    )
    path, fs = hadoop_path(spark, folder)
    found = [s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("bucket=")]
    return {n.removeprefix("bucket="): name for n in found}
