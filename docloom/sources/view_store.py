"""Stored views that follow their store: a base and layers of changes, folded together now and then."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators.view_changes import Define, index_changes, with_changes
from docloom.sources.buckets import changed_documents, read_buckets
from docloom.sources.tables import materialize, read_view, write_view
from docloom.sources.versions import publish, read_version, versions

MAX_LAYERS = 8
FOLD_SHARE = 0.25  # layers with this share of the base's rows are folded into it


def create_view(spark: SparkSession, root: str, store_root: str, define: Define) -> int:
    """Index the newest version of a bucketed store and keep the view under ``root``; its first version."""
    of_store, _ = read_version(spark, store_root)
    view = define(read_buckets(spark, store_root, of_store))
    return publish(spark, root, 1, _written_base(view, root) | {"store": of_store})


def follow(spark: SparkSession, root: str, store_root: str, define: Define) -> int:
    """Bring the view under ``root`` to the newest version of its store; the view's version.

    Only buckets of the store that were rewritten since the view's own version are read, and only index rows that
    changed are written, as one layer however many versions lie between. A view that was left behind, by a job that broke
    off between saving the store and this, catches up the next time. ``define`` must be the one the view was made with.
    """
    version, contents = read_version(spark, root)
    of_store, _ = read_version(spark, store_root)
    if of_store == contents["store"]:
        return version
    changed = materialize(changed_documents(spark, store_root, contents["store"], of_store), "view-documents")
    layer = materialize(index_changes(define, changed), "view-layer")
    rows = layer.count()
    told = contents | {"store": of_store}
    if rows:
        folder = _folder("layer")
        write_view(layer.select(*_schema(contents).names, "added"), f"{root.rstrip('/')}/{folder}")
        told["layers"] = [*contents["layers"], {"folder": folder, "rows": rows}]
    in_layers = sum(x["rows"] for x in told["layers"])
    if len(told["layers"]) > MAX_LAYERS or in_layers > max(1, FOLD_SHARE * told["base_rows"]):
        told |= _written_base(_view(spark, root, told), root)
    return publish(spark, root, version + 1, told)


def fold(spark: SparkSession, root: str) -> int:
    """Write base and layers as a new base."""
    version, contents = read_version(spark, root)
    if not contents["layers"]:
        return version
    return publish(spark, root, version + 1, contents | _written_base(_view(spark, root, contents), root))


def read_followed(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The view under ``root``: its base without the rows that later layers replace or remove, and what they add."""
    return _view(spark, root, read_version(spark, root, version)[1])


def is_followed(spark: SparkSession, root: str) -> bool:
    return bool(versions(spark, root))


def _folder(kind: str) -> str:
    return f"{kind}-{uuid.uuid4().hex}"


def _schema(contents: dict) -> T.StructType:
    return T.StructType.fromJson(contents["schema"])


def _written_base(view: DataFrame, root: str) -> dict:
    folder = _folder("base")
    write_view(view, f"{root.rstrip('/')}/{folder}")
    stored = read_view(view.sparkSession, f"{root.rstrip('/')}/{folder}", view.schema)
    return {"schema": view.schema.jsonValue(), "base": folder, "base_rows": stored.count(), "layers": []}


def _view(spark: SparkSession, root: str, contents: dict) -> DataFrame:
    schema = _schema(contents)

    def read(folder: str, schema: T.StructType) -> DataFrame:
        return read_view(spark, f"{root.rstrip('/')}/{folder}", schema)

    base = read(contents["base"], schema).select(*schema.names)
    if not contents["layers"]:
        return base
    with_added = T.StructType([*schema.fields, T.StructField("added", T.BooleanType())])
    layers = [read(x["folder"], with_added).withColumn("layer", F.lit(i)) for i, x in enumerate(contents["layers"])]
    return with_changes(base, reduce(DataFrame.unionByName, layers))
