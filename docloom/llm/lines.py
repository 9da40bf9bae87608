"""Line deduplication: ranks of line sequences by prefix doubling, and repeated runs from shared prefixes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import in_order, stored, with_columns, with_totals_before
from docloom.llm.sharding import text_key


def _lines(text: Column) -> Column:
    """The lines that hold words, with their place in the text, two hashes and the number of words."""
    line = lambda x, i: F.struct(
        i.alias("i"),
        F.xxhash64(x).alias("h1"),
        F.xxhash64(F.lit(1), x).alias("h2"),
        F.regexp_count(x, F.lit(r"\S+")).alias("w"),
    )
    return F.filter(F.transform(F.split(text, "\n"), line), lambda x: x["w"] > 0)


def repeated_runs(docs: DataFrame, least_words: int, text: str, doc_id: str) -> DataFrame:
    """
    ``id, key, runs``: for each document (its id and the key of its text) the line places of later copies.

    All documents' lines stand in one order, by id (null last). A rank stands for all line sequences of one length that
    are equal: it is the place where the first of them starts. Ranks of single lines come from their hashes, ranks of
    twice the length from pairs of ranks; only sequences that occur again go on, so each doubling works on less. Sorted
    by these ranks the lines' suffixes are a suffix array, and all suffixes that share their first ``l`` lines (an
    interval of common prefix ``l``) are told by the ranks of the two power-of-two stretches that cover them.

    A run of at least ``least_words`` words that starts at line i is repeated if its interval starts before i. The
    shortest such run counts, and longer ones up to where the run from line i + 1 takes over; together they cover every
    maximal repeated run, and there are at most two for each line. So doubling ends at ``least_words`` lines.
    """
    given = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("id"), text_key(F.col(text)).alias("key"), _lines(F.col(text)).alias("lines"))
    given = stored(given.where(F.size("lines") > 0).select("id", F.col("id").isNull().alias("no_id"), "key", "lines"), "lines")
    given = given.dropDuplicates(["id", "key"])
    placed = in_order(given, ["no_id", "id", "key"], "lines-placed")
    based = with_totals_before(placed, {"base": F.size("lines").cast("long")})

    @F.pandas_udf("array<struct<least:int,most:int>>")
    def reaches(words: pd.Series) -> pd.Series:
        """For each line how many lines make ``least_words`` words (0: too few follow), and the most to look at."""
        out = []
        for w in words:
            total = np.concatenate([[0], np.cumsum(w)])
            end = np.searchsorted(total, total[:-1] + least_words, "left")
            n, at = len(w), np.arange(len(w))
            enough = end <= n
            least = np.where(enough, end - at, 0)
            after = np.concatenate([least[1:], [0]])
            most = np.where(after > 0, np.maximum(least, after), n - at) * enough
            out.append([{"least": int(a), "most": int(b)} for a, b in zip(least, most, strict=True)])
        return pd.Series(out)

    zipped = F.arrays_zip(F.col("lines"), reaches(F.col("lines.w")).alias("reach"))
    lines = based.select("at", "base", F.posexplode(zipped).alias("j", "line")).select(
        (F.col("base") + F.col("j")).alias("pos"),
        F.col("at").alias("doc"),
        F.col("line.lines.i").alias("i"),
        F.col("line.lines.h1").alias("a"),
        F.col("line.lines.h2").alias("b"),
        F.col("line.reach.least").alias("least"),
        F.col("line.reach.most").alias("most"),
    )

    def ranked(rows: DataFrame, level: int) -> DataFrame:
        """Rows whose pair ``a, b`` occurs again, with the place of its first occurrence as rank."""
        first = rows.groupBy("a", "b").agg(F.min("pos").alias("rank"), F.count("*").alias("n")).where("n > 1").drop("n")
        return stored(rows.join(first, ["a", "b"]).drop("a", "b"), f"lines-{level}")

    levels = [ranked(lines, 0)]
    while 1 << len(levels) <= least_words + 1:
        held, length = levels[-1], 1 << (len(levels) - 1)
        follower = held.select((F.col("pos") - length).alias("pos"), F.col("doc").alias("of_doc"), F.col("rank").alias("b"))
        pairs = held.withColumnRenamed("rank", "a").join(follower, "pos").where("doc = of_doc").drop("of_doc")
        levels.append(ranked(pairs, len(levels)))
        if levels[-1].isEmpty():
            break

    runs = None
    for level, held in enumerate(levels):
        low, high = F.greatest("least", F.lit(1 << level)), F.least("most", F.lit((2 << level) - 1))
        wide = held.where((F.col("least") > 0) & (low <= high)).withColumn("l", F.explode(F.sequence(low, high)))
        ends = held.select(F.col("pos").alias("end_pos"), F.col("doc").alias("of_doc"), F.col("rank").alias("end_rank"))
        wide = wide.join(ends, F.col("pos") + F.col("l") - (1 << level) == F.col("end_pos")).where("doc = of_doc")
        wide = wide.select("doc", "pos", "l", "rank", "end_rank")
        runs = wide if runs is None else runs.unionByName(wide)
    runs = stored(runs, "lines-runs")
    interval = runs.groupBy("l", "rank", "end_rank").agg(F.min("pos").alias("first_pos"))
    later = runs.join(interval, ["l", "rank", "end_rank"]).where("pos > first_pos")
    by_doc = later.groupBy("doc", "pos").agg(F.max("l").alias("l")).groupBy("doc").agg(F.collect_list(F.struct("pos", "l")).alias("runs"))
    found = based.select("at", "id", "key", "base", F.col("lines.i").alias("places")).join(by_doc, F.col("at") == F.col("doc"))
    places = F.transform("runs", lambda r: F.slice("places", (r["pos"] - F.col("base") + 1).cast("int"), r["l"]))
    return found.select("id", "key", F.array_sort(F.array_distinct(F.flatten(places))).alias("runs"))


def without_repeats(docs: DataFrame, least_words: int = 50, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """
    Every row with ``clean_text``, ``n_lines`` and ``deleted_lines``: later copies of repeated line runs are gone.

    A line is deleted if it lies in a run of lines of at least ``least_words`` words in total that starts earlier too: in
    a document of smaller id (null last, then by text hash) or further up in the same one. Blank lines are no part of
    runs and stay. Null text stays null, with 0 lines. Rows that agree in id and text are one document and all get its
    clean text; equal texts under different ids are copies, so all but the first lose their lines. An empty table stays
    empty. Input columns named like the new ones give way to them; others are kept.

    A line that a third of all documents hold costs one row each: hot ranks are aggregated before the shuffle, and joins
    on ranks can be split.
    """
    runs = repeated_runs(docs, least_words, text, doc_id).select(F.col("id").alias("of_id"), F.col("key").alias("of_key"), "runs")
    keyed = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), text_key(F.col(text)).alias("key"))
    joined = keyed.join(runs, (F.col("key") == F.col("of_key")) & F.col("id").eqNullSafe(F.col("of_id")), "left")

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, places: pd.Series) -> pd.Series:
        out = []
        for t, gone in zip(texts, places, strict=True):
            if t is not None and gone is not None and len(gone):
                held = t.split("\n")
                keep = np.ones(len(held), bool)
                keep[gone] = False
                t = "\n".join(held[i] for i in np.flatnonzero(keep))
            out.append(t)
        return pd.Series(out, dtype=object)

    value = F.col("row")[text]
    n_lines = F.coalesce(F.size(F.split(value, "\n")), F.lit(0))
    return with_columns(
        "row",
        joined,
        clean_text=cleaned(value, F.col("runs")),
        n_lines=F.when(value.isNull(), 0).otherwise(n_lines).cast("long"),
        deleted_lines=F.coalesce(F.size("runs"), F.lit(0)).cast("long"),
    )
