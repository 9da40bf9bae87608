"""Near-duplicate documents: ProbMinHash signatures in bands, exact checks around popular members, connected classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import components, dropped, stored, with_columns
from docloom.llm.sharding import text_key
from docloom.llm.tokens import WordHashes, mixed, plain_words, runs, shingles

#: Characters of text looked at together.
_TOGETHER = 1_000_000
#: Members of a band that all others are compared with, round by round; in the last round each with each.
_PIVOTS = (1, 8, None)
#: One-bit registers of a fingerprint, and the standard deviations it may lie under what the threshold lets expect.
_BITS, _SLACK = 1024, 5.5


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """
    ProbMinHash signatures of weighted sets, one row of ``size`` hashes each.

    An element of weight w arrives at times of a Poisson process of rate w, each arrival at a random register; times and
    registers come from the element's hash alone. A register keeps the element that came first. Two sets agree in a
    register with the probability of their probability Jaccard similarity. All elements take their next arrival
    together; one whose time is later than every register of its set can change nothing more and stops.
    """
    first = np.full(len(sets) * size, np.inf)
    who = np.zeros(len(sets) * size, np.uint64)
    element = np.concatenate([e for e, _ in sets]) if sets else np.zeros(0, np.uint64)
    weight = np.concatenate([w for _, w in sets]) if sets else np.zeros(0)
    owner = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
    time = np.zeros(len(element))
    step = 0
    while len(element):
        step += 1
        drawn = mixed(element + np.uint64((step * 0x9E3779B97F4A7C15) % (1 << 64)))
        time = time - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        at = owner * size + (mixed(drawn) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, at, time)
        came = first[at] == time
        who[at[came]] = element[came]
        still = time < first.reshape(-1, size).max(axis=1)[owner]
        element, weight, owner, time = element[still], weight[still], owner[still], time[still]
    return who.reshape(len(sets), size)


def shingle_set(words: list[bytes], n: int, hashed: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``n`` words, each of weight 1: what links are told by."""
    found = np.unique(shingles(hashed.of(words), n))
    return found, np.ones(len(found))


def band_keys(texts: list[str | None], n: int, bands: int, rows: int, hashed: WordHashes) -> list[np.ndarray | None]:
    """A hash for each band of a text's signature; None for a text without words."""
    out: list[np.ndarray | None] = [None] * len(texts)
    for run in runs(texts, _TOGETHER):
        words = {i: w for i in run if (w := plain_words(texts[i]))}
        held = list(words)
        if held:
            found = signatures([shingle_set(w, n, hashed) for w in words.values()], bands * rows)
            parts = found.reshape(len(held), bands, rows)
            keys = np.repeat(mixed(np.arange(bands, dtype=np.uint64))[None, :], len(held), axis=0)
            for r in range(rows):
                keys = mixed(keys + parts[:, :, r])
            for i, k in zip(held, keys.view(np.int64), strict=True):
                out[i] = k
    return out


def fingerprints(texts: list[str | None], n: int, hashed: WordHashes) -> list[np.ndarray]:
    """One bit of each register of a large signature of the distinct shingles, packed into longs."""
    out: list[np.ndarray] = []
    for run in runs(texts, _TOGETHER):
        found = signatures([shingle_set(plain_words(texts[i]), n, hashed) for i in run], _BITS)
        bits = (mixed(found) & np.uint64(1)).astype(np.uint8)
        out += list(np.packbits(bits, axis=1).view(np.int64))
    return out


def most_differing(threshold: float) -> float:
    """Bits in which fingerprints of sets with a Jaccard similarity of ``threshold`` may differ."""
    agreeing = threshold + (1 - threshold) / 2
    return _BITS * (1 - agreeing) + _SLACK * (_BITS * agreeing * (1 - agreeing)) ** 0.5


def similarity(left: str | None, right: str | None, n: int, hashed: WordHashes) -> float:
    """Jaccard similarity of the distinct shingles of two texts."""
    a, b = (np.unique(shingles(hashed.of(plain_words(t)), n)) for t in (left, right))
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle_words: int = 5,
    threshold: float = 0.8,
    bands: int = 21,
    rows: int = 6,
) -> DataFrame:
    """
    Every row of ``docs`` with ``class_id`` (least id of its class), ``class_rows`` and ``kept`` (true for that row).

    Equal texts are one class at once. Different texts are linked if the distinct shingles of ``shingle_words`` words
    (all words of a shorter text) have a Jaccard similarity of ``threshold`` or more, computed from the whole texts;
    classes are what links connect. Signatures only propose: all shingles weigh the same, however often they occur, so
    that the probability Jaccard is the Jaccard similarity itself, and texts at 0.8 share one of 21 bands of 6 with
    probability 0.998.

    The texts that share a band are not paired with each other. First each band compares its members with one of them,
    the one that shares most bands with others, and classes are formed; a group of copies is one class then, for one
    comparison a member. Bands whose members are still in more than one class go on with eight such pivots, and what is
    left after that with each member against each, but only between classes, in the first band that two texts share, and
    if fingerprints of 1024 bits do not rule the similarity out (they err for about one pair in ten million at the threshold). So a
    pair that shares a band is either in one class already or compared, and only pairs that are nearly similar leave the
    join. The join itself still looks at all pairs of different classes in a band.

    Words are what stands between ASCII white space, as written. Texts without words (null, empty, white space) are not
    similar to anything: equal ones are one class only if not null and equal as text, each null is a class alone. Class
    ids are null where no row of the class has an id. Of rows that agree in id and text ``kept`` is true for all; a
    caller that wants one takes one (``one_of_each``). Input columns named like the new ones give way; others are kept.
    """

    @F.pandas_udf("array<long>")
    def keys_of(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashed = WordHashes()
        for batch in values:
            yield pd.Series(band_keys(list(batch), shingle_words, bands, rows, hashed), dtype=object)

    @F.pandas_udf("double")
    def similar(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hashed = WordHashes()
        for left, right in pairs:
            yield pd.Series(
                [similarity(a, b, shingle_words, hashed) for a, b in zip(left, right, strict=True)], dtype=float
            )

    given = docs.where(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("key"), F.col(doc_id).alias("id"), text)
    signed = given.select("key", "id", keys_of(text).alias("bands"))
    texts = signed.groupBy("key").agg(F.min("id").alias("first_id"), F.count("*").alias("n"), F.first("bands").alias("bands"))
    texts = stored(texts, "neardup-texts")

    @F.pandas_udf("array<long>")
    def bits_of(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashed = WordHashes()
        for batch in values:
            yield pd.Series(fingerprints(list(batch), shingle_words, hashed), dtype=object)

    banded = texts.select("key", F.posexplode("bands").alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("of")).where("of > 1")
    counted = stored(banded.join(shared, "bucket"), "neardup-counted")
    popular = counted.groupBy("key").agg(F.sum("of").alias("shared"))
    members = stored(counted.join(popular, "key"), "neardup-members")
    dropped(counted)
    firsts = texts.join(members.select("key").distinct(), "key", "left_semi").select("key", F.col("first_id").alias("id"))
    match = (given["key"] == firsts["key"]) & given["id"].eqNullSafe(firsts["id"])
    proposed = stored(given.join(firsts, match, "left_semi").select("key", text).dropDuplicates(["key"]), "neardup-proposed")

    def pivots_of(live: DataFrame, most: int | None) -> DataFrame:
        """The members of each band that share most bands with others."""
        order = Window.partitionBy("bucket").orderBy(F.desc("shared"), "key")
        return live.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most) if most else live

    def checked(pairs: DataFrame) -> DataFrame:
        """Pairs of a member and a pivot with their similarity, stored."""
        left = proposed.select(F.col("key").alias("pivot"), F.col(text).alias("pivot_text"))
        right = proposed.select(F.col("key").alias("member"), F.col(text).alias("member_text"))
        found = pairs.join(left, "pivot").join(right, "member")
        return stored(found.select("a", "b", similar("pivot_text", "member_text").alias("similarity")), "neardup-checked")

    not_ruled_out = " + ".join(f"bit_count(m.bits[{i}] ^ p.bits[{i}])" for i in range(_BITS // 64)) + f" <= {most_differing(threshold)}"
    first_shared = "array_position(zip_with(m.bands, p.bands, (x, y) -> x = y), true) = m.band + 1"
    named = (F.least("member", "pivot").alias("a"), F.greatest("member", "pivot").alias("b"))

    tested = links = roots = None
    live = members
    for most in _PIVOTS:
        on = "m.bucket = p.bucket AND m.key <> p.key"
        if roots is not None:
            on += f" AND m.root <> p.root AND {not_ruled_out} AND {first_shared}" + (" AND m.key < p.key" if not most else "")
        pairs = live.alias("m").join(pivots_of(live, most).alias("p"), F.expr(on))
        pairs = pairs.select(F.col("m.key").alias("member"), F.col("p.key").alias("pivot"))
        pairs = pairs.groupBy(*named).agg(F.min(F.struct("pivot", "member")).alias("one")).select("a", "b", "one.*")
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        more = checked(pairs)
        tested = more.select("a", "b") if tested is None else tested.unionByName(more.select("a", "b"))
        similar_pairs = more.where(F.col("similarity") >= threshold).select("a", "b")
        links = similar_pairs if links is None else links.unionByName(similar_pairs)
        roots = components(links, "neardup-roots").select(F.col("id").alias("key"), "root")
        if not most:
            break
        unsettled = members.where(F.col("of") > most + 1).join(roots, "key", "left")
        unsettled = unsettled.withColumn("root", F.coalesce("root", "key"))
        several = unsettled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        several = several.where("low <> high").select("bucket")
        unsettled = stored(unsettled.join(several, "bucket", "left_semi"), "neardup-unsettled")
        keys = unsettled.select("key").distinct()
        bits = proposed.join(keys, "key", "left_semi").select("key", bits_of(text).alias("bits"))
        told = bits.join(texts.select("key", "bands"), "key")
        live = stored(unsettled.join(told, "key"), "neardup-live")
        dropped(unsettled)

    grouped = texts.join(roots, "key", "left").select("key", "first_id", "n", F.coalesce("root", "key").alias("root"))
    least = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "key")).alias("least")
    classes = grouped.groupBy(F.col("root").alias("of_root")).agg(least, F.sum("n").alias("class_rows"))
    of_text = grouped.join(classes, F.col("root") == F.col("of_root")).select(
        F.col("key").alias("of_key"), F.col("least.first_id").alias("class_id"), F.col("least.key").alias("kept_key"), "class_rows"
    )
    keyed = docs.select(F.struct("*").alias("row"), text_key(F.col(text)).alias("key"), F.col(doc_id).alias("id"), F.col(text).isNull().alias("none"))
    keyed = keyed.withColumn("key", F.when(~F.col("none"), F.col("key")))
    joined = keyed.join(of_text, F.col("key") == F.col("of_key"), "left")
    kept = F.col("none") | ((F.col("key") == F.col("kept_key")) & F.col("id").eqNullSafe(F.col("class_id")))
    return with_columns(
        "row",
        joined,
        class_id=F.when(F.col("none"), F.col("id")).otherwise(F.col("class_id")),
        class_rows=F.coalesce("class_rows", F.lit(1)).cast("long"),
        kept=kept,
    )


def one_of_each(marked: DataFrame, columns: list[str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that ``near_duplicates`` keeps, one of those that agree in id and text; null texts all stay."""
    kept = marked.where("kept")
    key = text_key(F.col(text))
    first = Window.partitionBy(key, doc_id).orderBy(*[c for c in columns if c not in (text, doc_id)], doc_id)
    placed = kept.withColumn("kept", F.row_number().over(first))
    return placed.where((F.col("kept") == 1) | F.col(text).isNull()).select(*columns)
