"""From documents to shards: quality, near-duplicates, benchmark passages, source weights, shards; one stage each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import decontaminate, mixing, neardup, quality, sharding
from docloom.llm.common import stored, table
from docloom.llm.queries import SHARDS, WEIGHTS, held_out

#: A document goes only if its score says that it is more likely bad than good by this much.
REJECTED_BELOW = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """
    Documents that the classifier does not reject.

    Null, empty and white texts score 0 and go; repeated rows and ties score alike and stay or go together. Rows with a null
    id are scored like others. An empty table stays empty. All columns are returned as they came, whatever their names.
    """
    model = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out())
    scored = quality.score(_carried(docs, "text"), model)
    return _restored(scored.where(F.col("score") >= REJECTED_BELOW), docs, "text")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """
    One document of each class of near-duplicates, that of the least id.

    Of repeated rows with this id and text one stays. Null texts are alone and all stay; equal empty texts are one class.
    Long texts are compared whole. An empty table stays empty. All columns are returned as they came.
    """
    marked = neardup.near_duplicates(_carried(docs, "doc_id", "text"))
    return _restored(neardup.one_of_each(marked, ["doc_id", "text", _DOC]), docs, "doc_id", "text")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """
    Documents without a benchmark passage.

    Null and empty texts hold none and stay; repeated rows stay or go together. With an empty benchmark all stay. All
    columns are returned as they came.
    """
    marked = decontaminate.mark(_carried(docs, "text"), table(spark, sf_dir, "benchmark"))
    return _restored(marked.where(~F.col("contaminated")), docs, "text")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """
    Documents as often as their source's weight asks for.

    Texts without words take no room and come once or as often as their place in the order says; a null source is a source
    of its own. Repeated rows are drawn one by one, ties in size by id. An empty table stays empty. All columns are returned
    as they came.
    """
    sized = docs.select(F.struct("*").alias("doc"), "doc_id", "source", mixing.words(F.col("text")).alias("size"))
    return mixing.repeated(mixing.mix(sized, WEIGHTS), ["doc"]).select("doc.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """
    Documents with their shard and their place in it.

    Null texts have one byte, for the end of the row. Rows alike in text and id have places next to each other. An empty
    table stays empty. Columns named ``shard`` or ``slot`` give way to the new ones; all others are returned as they came.
    """
    text, kept = F.col("text"), docs.drop("shard", "slot").columns
    keyed = docs.select(
        F.struct(*kept).alias("doc"), "doc_id", sharding.text_key(text).alias("text_key"), sharding.byte_size(text).alias("size")
    )
    return sharding.shard(keyed, SHARDS).select("doc.*", "shard", "slot")


#: The column in which the documents' other columns pass through an operator, out of reach of the names it gives.
_DOC = "document"


def _carried(docs: DataFrame, *needed: str) -> DataFrame:
    """``needed`` as columns, all others in one struct."""
    others = [F.col(c) for c in docs.columns if c not in needed] or [F.lit(0).alias("none")]
    return docs.select(*needed, F.struct(*others).alias(_DOC))


def _restored(result: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    return result.select(*[F.col(c) if c in needed else F.col(_DOC)[c].alias(c) for c in docs.columns])


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: SQL cannot say the learned and the hashed stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
