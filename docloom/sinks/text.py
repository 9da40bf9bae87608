"""Key-value text: one ``id SEPARATOR document`` line per row, plain or in numbered pages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import escape_text, unescape_text
from docloom.sources.files import arrow_path, write_whole

PAGE_NAME = "part-%05d"  # fixed value: page file naming


def kv_line(doc_id: Column, value: Column, *, separator: str = "\t", escape: bool = True) -> Column:
    """The text line of one document. Without ``escape`` it is the bare concatenation, and a document
    with a line break spans several lines."""
    if not escape:
        return F.concat(doc_id, F.lit(separator), value)
    return F.concat(escape_text(doc_id), F.lit(separator), escape_text(value))


def kv_lines(docs: DataFrame, *, separator: str = "\t", escape: bool = True) -> DataFrame:
    """One text column ``value`` from ``docs(doc_id, value)``."""
    return docs.select(
        kv_line(F.col("doc_id"), F.col("value"), separator=separator, escape=escape).alias("value")
    )


def write_kv_text(
    docs: DataFrame, path: str, *, separator: str = "\t", escape: bool = True, mode: str = "errorifexists"
) -> None:
    kv_lines(docs, separator=separator, escape=escape).write.mode(mode).text(path)


def parse_kv_lines(
    lines: DataFrame, line: str = "value", *, separator: str = "\t", escaped: bool = True
) -> DataFrame:
    """``(doc_id, value)`` of key-value lines: the key ends at the first separator.

    A line without separator is no document; ``bad_kv_lines`` counts those.
    """
    undo = unescape_text if escaped else (lambda c: c)
    at = F.instr(F.col(line), separator)
    end = F.length(line)
    return lines.where(at > 0).select(
        undo(F.substring(F.col(line), F.lit(1), at - 1)).alias("doc_id"),
        undo(F.substring(F.col(line), at + len(separator), end)).alias("value"),
    )


def bad_kv_lines(lines: DataFrame, line: str = "value", *, separator: str = "\t") -> DataFrame:
    """Count of lines without separator, as a metrics row."""
    bad = F.count_if(~F.contains(F.col(line), F.lit(separator)))
    return lines.agg(bad.alias("value")).select(F.lit("LINES_WITHOUT_SEPARATOR").alias("counter"), "value")


def read_kv_text(
    spark: SparkSession, path: str, *, separator: str = "\t", escaped: bool = True
) -> DataFrame:
    return parse_kv_lines(spark.read.text(path), separator=separator, escaped=escaped)


def page_lines(
    pages: DataFrame, *, separator: str = "\t", escape: bool = True, page: str = "page_no"
) -> DataFrame:
    """``(page, value)`` with the page's file name and the text line, ready to be written."""
    return pages.select(
        F.format_string(PAGE_NAME, F.col(page)).alias("page"),
        kv_line(F.col("doc_id"), F.col("value"), separator=separator, escape=escape).alias("value"),
    )


def write_pages(
    pages: DataFrame, path: str, *, separator: str = "\t", escape: bool = True, mode: str = "errorifexists"
) -> None:
    """One file per page, in the folder ``page=part-NNNNN``, lines in ID order.

    A page is bounded by the page size, so bringing each page into one task cannot overload it.
    """
    lines = pages.select(
        F.format_string(PAGE_NAME, F.col("page_no")).alias("page"),
        kv_line(F.col("doc_id"), F.col("value"), separator=separator, escape=escape).alias("value"),
        "doc_id",
    )
    # The order starts with the folder column, so the writer keeps it.
    placed = lines.repartition("page").sortWithinPartitions("page", "doc_id")
    placed.select("page", "value").write.mode(mode).partitionBy("page").text(path)


def write_page_files(
    pages: DataFrame, path: str, *, separator: str = "\t", escape: bool = True
) -> tuple[int, int]:
    """One file for each page, ``path/part-NNNNN``, lines in ID order; how many files and lines there are.

    Rows without document write no line, but their page has its file. A page is bounded by the page size: it is brought
    into one task and written from there, under another name first, so that a task that runs again leaves no second file
    and no half one. ``_SUCCESS`` is written last. The folder must be new, and one that executors can write through Arrow's
    file systems.
    """
    fs, folder = arrow_path(path.rstrip("/"))
    if fs.get_file_info(folder).type.name != "NotFound":
        raise FileExistsError(path)
    fs.create_dir(folder, recursive=True)
    line = kv_line(F.col("doc_id"), F.col("value"), separator=separator, escape=escape)
    lines = pages.select(F.format_string(PAGE_NAME, F.col("page_no")).alias("page"), "doc_id", line.alias("line"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = arrow_path(path.rstrip("/"))
        page, held = None, []

        def done() -> pd.DataFrame:
            write_whole(fs, f"{folder}/{page}", "".join(f"{x}\n" for x in held).encode())
            return pd.DataFrame({"page": [page], "n_lines": [len(held)]})

        for batch in batches:
            for of, line in zip(batch["page"], batch["line"], strict=True):
                if of != page:
                    if page is not None:
                        yield done()
                    page, held = of, []
                if line is not None:
                    held.append(line)
        if page is not None:
            yield done()

    placed = lines.repartition("page").sortWithinPartitions("page", "doc_id")
    found = placed.mapInPandas(write, "page string, n_lines bigint").agg(F.count("*"), F.sum("n_lines")).first()
    write_whole(fs, f"{folder}/_SUCCESS", b"")
    return found[0], found[1] or 0
