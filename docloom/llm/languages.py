"""Language identification by compression against per-language dictionaries of raw text."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import with_columns

#: Without a learned language.
UNDETERMINED = "und"
_NOT_LETTERS = regex.compile(r"\P{L}+")
#: Groups by hash in which the texts of a language are ranked before the first of each group are.
_RANKED_APART = 64
#: Bytes compressed at a time. Up to 32 KB zstandard keeps the tables of a dictionary whole beside those of the text.
_PIECE = 1 << 14


def letters(text: str) -> bytes:
    """Lower-case letters with single spaces between words: what languages are told by."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def learn_dictionaries(
    docs: DataFrame,
    learn_from: Column,
    text: str = "text",
    lang: str = "lang",
    sample_rows: int = 200,
    dictionary_bytes: int = 1 << 16,
) -> dict[str, bytes]:
    """
    One dictionary of raw text for each non-null language of the rows that ``learn_from`` allows.

    A bounded sample: for each language at most ``sample_rows`` different texts, those with the smallest hash, and of
    them as many as fit into ``dictionary_bytes``: whole texts, and of a text of more than ``dictionary_bytes`` bytes a
    sixteenth of as many letters from its middle. Hashes are ranked without the texts, first in groups of hashes, so that
    one task ranks a bounded number however large a language is; then only the chosen texts are fetched. Languages come in order of their rows, most first. A language without a letter in its sample is not learned.
    """
    usable = docs.where(learn_from & F.col(lang).isNotNull() & F.col(text).isNotNull())
    marked = usable.select(F.col(lang).alias("lang"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    chosen = marked.select("lang", "mark").distinct().withColumn("apart", F.pmod("mark", F.lit(_RANKED_APART)))
    for group in (("lang", "apart"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*group).orderBy("mark"))
        chosen = chosen.withColumn("place", place).where(F.col("place") <= sample_rows).drop("place")
    chosen = chosen.drop("apart")
    only_letters, part = F.regexp_replace("text", r"[^\p{L}]+", " "), max(1, dictionary_bytes // 16)
    middle = F.greatest(F.lit(1), F.floor((F.length(only_letters) - part) / 2) + 1).cast("int")
    taken = F.when(F.octet_length("text") <= dictionary_bytes, F.col("text")).otherwise(F.substring(only_letters, middle, F.lit(part)))
    picked = marked.join(F.broadcast(chosen), ["lang", "mark"]).groupBy("lang", "mark").agg(F.min(taken).alias("text"))
    rows = {r.lang: r.n for r in usable.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).toLocalIterator()}
    held: dict[str, bytes] = {}
    for row in picked.orderBy("lang", "mark").toLocalIterator():
        more = held.get(row.lang, b"") + letters(row.text) + b" "
        if len(more) <= dictionary_bytes and more.strip():
            held[row.lang] = more
    return {name: held[name] for name in sorted(held, key=lambda n: (-rows[n], n))}


def compressors(dictionaries: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    """One for each language. Short matches count, since words and their endings are short."""
    given = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY,
        min_match=4,
        window_log=18,
        hash_log=16,
        chain_log=16,
        search_log=4,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    made = []
    for name, raw in dictionaries.items():
        held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=given)
        made.append((name, zstandard.ZstdCompressor(dict_data=held, compression_params=given)))
    return made


def compressed_size(compressor: zstandard.ZstdCompressor, data: bytes) -> int:
    """Bytes of all pieces of ``data``, each compressed with the fresh dictionary."""
    return sum(len(compressor.compress(data[i : i + _PIECE])) for i in range(0, len(data), _PIECE))


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    text: str = "text",
    least_margin: float = 0.01,
    scale: float = 4.0,
) -> DataFrame:
    """
    Every row with ``lang_pred``, ``score``, ``margin`` and ``sure``.

    The whole text, reduced to lower-case letters, is compressed with each dictionary in pieces of 16 KB, each against
    the fresh dictionary, so that every part of a long text counts alike; the smallest sum of sizes names
    the language, of equal ones the first in ``dictionaries`` (the one learned from most rows). ``margin`` is how much smaller it is than the next, as a share of the
    next; under ``least_margin`` the answer is rejected: ``sure`` is false, and ``lang_pred`` only names the nearest.
    ``score`` is 1 / sum over languages of exp((smallest - size) / scale).

    Null text, text without a letter, and any text if no language was learned: ``und``, score 0, margin 0, not sure. A
    text of any length is one value of one task. Input columns named like the new ones give way; others are kept.
    """

    @F.pandas_udf("lang_pred string, score double, margin double, sure boolean")
    def answers(values: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        by_language = compressors(dictionaries)

        def answer(value: str | None) -> tuple[str, float, float, bool]:
            data = letters(value) if value else b""
            if not data or not by_language:
                return UNDETERMINED, 0.0, 0.0, False
            ranked = sorted((compressed_size(c, data), i) for i, (_, c) in enumerate(by_language))
            least, first = ranked[0]
            margin = 1 - least / ranked[1][0] if len(ranked) > 1 else 1.0
            score = 1 / sum(math.exp((least - n) / scale) for n, _ in ranked)
            return by_language[first][0], score, margin, margin >= least_margin

        for batch in values:
            yield pd.DataFrame([answer(v) for v in batch], columns=["lang_pred", "score", "margin", "sure"])

    found = docs.select(F.struct("*").alias("row"), answers(F.col(text)).alias("found"))
    return with_columns("row", found, **{n: F.col("found")[n] for n in ("lang_pred", "score", "margin", "sure")})
