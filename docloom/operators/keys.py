"""View-key plans: from key specs to one row per key, with list order and chunk numbers."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.jsonkeys import canonical_key_sql
from docloom.functions.keyspec import RANGE_FIELDS, key_range, range_member, split_key_spec

MAX_LOCAL_KEYS = 10_000
_RANGE_BLOCK = 65_536  # keys made from one array, so a huge range never becomes one huge array


def expand_keys(specs: DataFrame, spec: str, *, num_chunks: str | int | None = None) -> DataFrame:
    """Expand the spec of every row of ``specs`` into its keys.

    ``spec`` (and ``num_chunks``, if not a number) is a column name or SQL expression. Adds ``pos`` (place
    of the key in the list), ``sub_pos`` (place within its range), ``key_ord`` (place among all expanded
    keys of the spec), ``raw_key``, ``view_key`` (canonical) and ``chunk_id``. Keys listed twice give two
    rows. Everything is computed inside the row, without a shuffle.
    """
    own = specs.columns
    chunks = "_total" if num_chunks is None else f"greatest(cast({num_chunks} AS bigint), 1L)"
    split = specs.selectExpr(*own, f"{split_key_spec(spec)} AS _keys")
    # How many keys come before each listed key; the last number is the count of all keys.
    counted = split.selectExpr(
        "*",
        f"""aggregate(_keys, array(0L), (acc, key) ->
              array_append(acc, element_at(acc, -1) + {key_range("key")}.n)) AS _offsets""",
    ).selectExpr("*", "element_at(_offsets, -1) AS _total")
    # The parsed fields become plain columns: a struct carried through two generators would be pruned
    # field by field, which Spark 4.1 does not survive.
    ranges = (
        counted.selectExpr(
            *own,
            f"greatest(cast(ceil(_total / {chunks}) AS bigint), 1L) AS _per_chunk",
            "_offsets",
            # The outer form keeps the optimizer from splitting the specs of all source rows, early, only to
            # test for empty lists.
            "posexplode_outer(_keys) AS (pos, _raw)",
        )
        .where("_raw IS NOT NULL")
        .selectExpr(*own, "_per_chunk", "_offsets[pos] AS _offset", "pos", f"{key_range('_raw')} AS _key")
        .selectExpr(*own, "_per_chunk", "_offset", "pos", *[f"_key.{f} AS _{f}" for f in RANGE_FIELDS])
        .where("_n > 0")
    )
    return (
        ranges.selectExpr("*", f"explode(sequence(0L, _n - 1, {_RANGE_BLOCK}L)) AS _from")
        .selectExpr("*", f"explode(sequence(_from, least(_from + {_RANGE_BLOCK}L, _n) - 1)) AS sub_pos")
        .selectExpr("*", f"{range_member('_prefix', '_low', '_width', '_suffix', 'sub_pos')} AS raw_key")
        .selectExpr(
            *own,
            "pos",
            "sub_pos",
            "_offset + sub_pos AS key_ord",
            "raw_key",
            f"{canonical_key_sql('raw_key')} AS view_key",
            "floor((_offset + sub_pos) / _per_chunk) AS chunk_id",
        )
    )


def plan_keys(spark: SparkSession, key_spec: str, *, num_chunks: int | None = None) -> DataFrame:
    """Key plan of one literal spec; ``num_chunks`` defaults to one chunk per key.

    A plan of ordinary size is computed once and becomes a local table, which later plans read without
    expanding the spec again; a larger one stays an expression.
    """
    if num_chunks is not None and num_chunks < 1:
        raise ValueError("num_chunks must be at least 1")
    spec = spark.range(1, numPartitions=1).select(F.lit(key_spec).alias("key_spec"))
    keys = expand_keys(spec, "key_spec", num_chunks=num_chunks).drop("key_spec")
    listed = keys.limit(MAX_LOCAL_KEYS + 1).toArrow()
    return keys if listed.num_rows > MAX_LOCAL_KEYS else spark.createDataFrame(listed, keys.schema)


MAX_INTERVALS = 1000
_NUMBER = "\ue000"  # stands for the number of a range while its key is read as JSON; no key part holds it


@dataclass(frozen=True)
class Interval:
    """The keys of one entry of a spec, by key part: a text, ``(before, low, high, width, after)`` of a range, or anything."""

    parts: tuple[str | tuple[str, int, int, int, str] | None, ...]

    def holds(self, columns: list[str]) -> Column:
        """Whether a view row may have a key of this interval; a test on its key parts that no key of it fails."""
        return reduce(Column.__and__, [_part_holds(F.col(c), p) for c, p in zip(columns, self.parts)], F.lit(True))


def key_intervals(spark: SparkSession, key_spec: str, n_parts: int) -> list[Interval] | None:
    """The entries of a spec as intervals of key parts, none of them expanded.

    None if there are more than ``MAX_INTERVALS``, or one that is no JSON array of ``n_parts`` plain values.
    """
    spec = spark.range(1, numPartitions=1).select(F.lit(key_spec).alias("key_spec"))
    entries = spec.selectExpr(f"explode({split_key_spec('key_spec')}) AS raw").selectExpr(f"{key_range('raw')} AS key")
    found = entries.selectExpr("key.*").where("n > 0").limit(MAX_INTERVALS + 1).collect()
    intervals = [_interval(r, n_parts) for r in found]
    return None if len(found) > MAX_INTERVALS or None in intervals else intervals


def _interval(r, n_parts: int) -> Interval | None:
    try:
        if r["low"] is None:
            values = json.loads(r["prefix"])
            parts = [_part_text(v) for v in values]
        else:
            parts = _range_parts(r)
    except (ValueError, TypeError):
        return None
    return Interval(tuple(parts)) if len(parts) == n_parts else None


def _range_parts(r) -> list:
    def key(number: int | str) -> list:
        return json.loads(f"{r['prefix']}{number}{r['suffix']}")

    try:  # inside a text part
        values = key(_NUMBER)
    except ValueError:  # a number of its own, or its last digits
        ends = key(r["low"]), key(r["high"])
        if r["width"] > len(str(r["low"])):
            return [None] * len(ends[0])  # zeros in front are no JSON number
        parts: list = []
        for a, b in zip(*ends, strict=True):
            # Numbers grow with their last digits, below zero they fall.
            parts.append(_part_text(a) if a == b else ("", min(a, b), max(a, b), 0, "") if type(a) is type(b) is int else None)
        return parts
    parts = []
    for v in values:
        if isinstance(v, str) and _NUMBER in v:
            before, after = v.split(_NUMBER)
            parts.append((before, r["low"], r["high"], r["width"], after))
        else:
            parts.append(_part_text(v))
    return parts


def _part_text(value) -> str | None:
    """How a key part is kept as text; None where the spelling may differ."""
    if isinstance(value, str):
        return value
    if value is None or isinstance(value, bool):
        return json.dumps(value)
    return str(value) if isinstance(value, int) else None


def _part_holds(part: Column, wanted) -> Column:
    if wanted is None:
        return F.lit(True)
    if isinstance(wanted, str):
        return part == wanted
    before, low, high, width, after = wanted
    if width:  # padded numbers sort as texts do
        return part.between(f"{before}{low:0{width}d}{after}", f"{before}{high:0{width}d}{after}") & part.endswith(after)
    number = F.substring(part, F.lit(len(before) + 1), F.length(part) - F.lit(len(before) + len(after)))
    return part.startswith(before) & part.endswith(after) & number.try_cast("bigint").between(low, high)


def assign_chunks(keys: DataFrame, n_keys: int, num_chunks: int, *, order: str = "key_ord") -> DataFrame:
    """Number contiguous chunks of ``ceil(n_keys / num_chunks)`` keys; there may be fewer than asked for."""
    per_chunk = max(-(-n_keys // max(num_chunks, 1)), 1)
    return keys.withColumn("chunk_id", F.floor(F.col(order) / per_chunk))


def place_by_chunk(df: DataFrame, num_chunks: int, *, chunk: str = "chunk_id") -> DataFrame:
    """One Spark partition per chunk, for sinks where the chunk decides the output file."""
    return df.repartitionById(num_chunks, F.col(chunk).cast("int"))
