"""One query for each operator over the test tables, as the contracts name their columns, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import (
    chat, decontaminate, languages, lines, mixing, neardup, negatives, neighbours, pages, periodic, quality, sharding, topk,
)
from docloom.llm.common import fold_key, table

#: Words and weights of the mix; shards; the score from which a document counts as good.
WEIGHTS, SHARDS, GOOD = [5.0, 2.0, 1.0], 8, 0.7


def held_out() -> F.Column:
    return F.coalesce(F.expr(f"{fold_key()} = 2"), F.lit(False))


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs).select("doc_id", "class_id", "class_rows", "kept")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.mark(docs, table(spark, sf_dir, "benchmark")).drop("text")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    odd = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    made = chat.windows(turns.unionByName(odd))
    read = chat.read_back(made).join(
        made.select(F.col("conv_id").alias("c"), F.col("starts_at").alias("s"), F.length("formatted").alias("chars")),
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("starts_at") == F.col("s")),
    )
    said_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.select("conv_id", "starts_at", F.size("turns").alias("n"), said_turns.alias("said"), "loss_text", "chars")
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("starts_at", "said", "loss_text"))).alias("parts"),
        F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_windows"),
    )
    loss = F.array_join("parts.loss_text", "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join("parts.said", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
        "n_windows",
    )


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # The words are counted before rows move, so texts stay where they are.
    sized = docs.select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    mixed = mixing.mix(sized, WEIGHTS)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )


def op5_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    sized = table(spark, sf_dir, "documents").select(
        "doc_id",
        sharding.byte_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        sharding.text_key(text).alias("text_key"),
    )
    cut = sharding.shard(sized, SHARDS)
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.without_repeats(docs).select("doc_id", "n_lines", "deleted_lines", F.col("clean_text").alias("text"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out())
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = languages.learn_dictionaries(docs, ~held_out())
    found = languages.identify(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "sure")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h")
    )
    # From its a-th word on, one text in ten says its next p words over and over.
    words = docs.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    cut = words.withColumn("n", F.size("w")).withColumn("a", F.expr("h DIV 10 % nullif(n, 0)"))
    cut = cut.withColumn("p", F.expr("1 + (n - a) DIV (3 + h DIV 10 % 8)"))
    periodic_text = "array_join(transform(sequence(0, n - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')"
    said = cut.select("doc_id", F.expr(f"if(n > 0, {periodic_text}, text)").alias("text"))
    best = F.array_max(F.transform("found.runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))["run"]
    listed = F.transform("found.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = periodic.with_runs(said, F.col("text")).withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda t: F.concat(t, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("found.collapsed", 256).alias("collapsed_sha256"),
    )


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash,
        op2_decontaminate,
        op3_chat,
        op4_mix,
        op5_pages,
        op6_shard,
        op7_lines,
        op8_quality,
        op9_neighbours,
        op10_language,
        op11_negatives,
        op12_runs,
        op13_topk,
    )
}

ORACLES = {
    "op3_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) r(i)
), counted AS (
  SELECT *, len(regexp_extract_all(said, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) + 4 AS tokens,
    24 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'))
      + length(regexp_replace(said, '<(\\*)\|', '<\\\1|', 'g')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS rn, count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns
), headed AS (
  SELECT *, rn = 1 AND n > 1 AND role = 'system' AS is_head,
    max(CASE WHEN rn = 1 AND n > 1 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id) AS head,
    max(CASE WHEN rn = 1 AND n > 1 AND role = 'system' THEN chars END) OVER (PARTITION BY conv_id) AS head_chars
  FROM counted
), strides AS (
  SELECT *, greatest((512 - coalesce(head, 0)) // 2, 1) AS stride,
    CASE WHEN tokens > greatest((512 - coalesce(head, 0)) // 2, 1) THEN 1 ELSE 0 END AS long
  FROM headed WHERE NOT is_head
), summed AS (
  SELECT *, coalesce(sum(tokens) OVER earlier, 0) AS before, coalesce(sum(long) OVER earlier, 0) AS long_before FROM strides
  WINDOW earlier AS (PARTITION BY conv_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), spanned AS (
  SELECT *, min(before) OVER span AS starts_at, sum(tokens) OVER span AS new_tokens FROM summed
  WINDOW span AS (PARTITION BY conv_id, before // stride, 2 * long_before + long)
), spans AS (
  SELECT conv_id, starts_at, any_value(new_tokens) AS new_tokens, any_value(head_chars) AS head_chars, sum(chars) AS chars,
    least(128, 512 - coalesce(any_value(head), 0) - any_value(new_tokens)) AS room
  FROM spanned GROUP BY conv_id, starts_at
), again AS (
  SELECT w.conv_id, sum(w.chars) AS chars FROM spanned w
  JOIN spans s ON s.conv_id = w.conv_id AND s.starts_at = w.starts_at + w.new_tokens AND s.starts_at - w.before <= s.room
  GROUP BY w.conv_id
), windows AS (
  SELECT conv_id, count(*) AS n_windows, sum(chars + coalesce(head_chars, 0)) AS chars FROM spans GROUP BY conv_id
), digests AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY rn)) AS turns_sha256,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN said END, '' ORDER BY rn), '') AS loss
  FROM counted GROUP BY conv_id
)
SELECT d.conv_id, d.n_turns, d.turns_sha256, length(d.loss) AS loss_chars, sha256(d.loss) AS loss_sha256,
  CAST(w.chars + coalesce(a.chars, 0) AS BIGINT) AS formatted_chars, w.n_windows
FROM digests d JOIN windows w ON w.conv_id = d.conv_id LEFT JOIN again a ON a.conv_id = d.conv_id
""",
    "op4_mix": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER rising, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER rising, 0)) AS level
  FROM sources
  WINDOW rising AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(3.0 * source_size, weight * max(level) OVER ()) AS target FROM levels
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 1048576) AS BIGINT) ELSE 0 END AS rate,
    CAST(('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 5)) AS BIGINT) AS moved
  FROM targets
), placed AS (
  SELECT s.*, r.source_size, r.target, r.rate, r.moved,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS FIRST) AS n
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
), drawn AS (
  SELECT *, ((moved + rate * n) >> 20) - ((moved + rate * (n - 1)) >> 20) AS copies FROM placed
)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, source, CAST(copies AS BIGINT) AS copies
FROM drawn
""",
    "op6_shard": r"""
WITH steps AS (
  SELECT list(v ORDER BY b) AS crcs FROM (
    SELECT b, list_reduce(range(8), lambda x, bit: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END), b) AS v
    FROM range(256) AS r(b))
), sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, md5(coalesce(text, '')) AS grp,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: CAST('0x' || p AS BIGINT)) AS bytes
  FROM documents
), placed AS (
  SELECT doc_id, size, grp, xor(4294967295, list_reduce(
      bytes, lambda crc, byte: xor(crcs[(xor(crc, byte) & 255) + 1], crc >> 8), 4294967295::BIGINT)) AS text_crc32,
    CAST(coalesce(sum(size) OVER before, 0) AS BIGINT) AS bytes_before, row_number() OVER (ORDER BY grp, doc_id) - 1 AS rows_before,
    CAST(sum(size) OVER () AS BIGINT) AS total
  FROM sized, steps
  WINDOW before AS (ORDER BY grp, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), groups AS (
  SELECT grp, min(bytes_before) AS s, max(bytes_before + size) AS e, any_value(total) AS total,
    least(min(bytes_before) * 8 // any_value(total), 7) AS low,
    least((max(bytes_before + size) - 1) * 8 // any_value(total), 7) AS high
  FROM placed GROUP BY grp
), whole AS (
  SELECT grp, CASE WHEN high * (total / 8) - s >= e - high * (total / 8) THEN low ELSE high END AS shard
  FROM groups WHERE low < high AND e - s <= 0.01 * (total / 8)
), cut AS (
  SELECT p.*, CAST(coalesce(w.shard, least(bytes_before * 8 // p.total, 7)) AS INTEGER) AS shard
  FROM placed p LEFT JOIN whole w USING (grp)
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, rows_before - min(rows_before) OVER (PARTITION BY shard) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM cut
""",
    "op11_negatives": """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
    CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
  FROM usable a JOIN usable o ON a.vec_id % 100 = 0 AND o.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
  n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 100 * n.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
QUALIFY rank <= 10
""",
    "op12_runs": r"""
WITH digits AS (
  SELECT row_number() OVER () AS row_id, doc_id, text, [ascii(c) FOR c IN split(CAST(doc_id AS VARCHAR), '')] AS bytes FROM documents
), hashed AS (
  SELECT *, xor(4294967295, list_reduce(bytes, lambda crc, byte: list_reduce(
      range(8), lambda x, bit: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END), xor(crc, byte)),
    4294967295::BIGINT)) AS h
  FROM digits
), given AS (
  SELECT row_id, doc_id, h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM hashed
), cut AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN h // 10 % len(w) END AS a, 3 + h // 10 % 8 AS parts FROM given
), words AS (
  SELECT row_id, i, n, CASE WHEN a IS NULL OR i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // parts) + 1] END AS word
  FROM cut, unnest(range(n)) AS r(i)
), pairs AS (
  SELECT x.row_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON y.row_id = x.row_id AND y.word = x.word
    AND y.i > x.i AND 2 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT row_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row_id, q ORDER BY i) AS island FROM pairs) GROUP BY row_id, q, island
  HAVING count(*) >= q AND count(*) + q >= 12
), runs AS (
  SELECT row_id, start, length, min(q) AS period FROM stretches GROUP BY row_id, start, length
), dropped AS (
  SELECT DISTINCT row_id, i FROM runs, unnest(range(start + period, start + length)) AS r(i)
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY length DESC, start, period) = 1
), listed AS (
  SELECT row_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS said
  FROM runs GROUP BY row_id
), collapsed AS (
  SELECT row_id, string_agg(word, ' ' ORDER BY i) AS said
  FROM words LEFT JOIN dropped USING (row_id, i) WHERE dropped.i IS NULL GROUP BY row_id
)
SELECT g.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period,
  1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(l.said, '')) AS runs_sha256, sha256(coalesce(c.said, '')) AS collapsed_sha256
FROM given g LEFT JOIN listed l USING (row_id) LEFT JOIN best b USING (row_id) LEFT JOIN collapsed c USING (row_id)
""",
    "op13_topk": """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id,
  CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, o.v) DESC, o.vec_id) AS INTEGER) AS rank,
  o.vec_id, CAST(list_inner_product(q.v, o.v) AS BIGINT) AS score
FROM usable q JOIN usable o ON q.vec_id % 20 = 0 AND o.vec_id <> q.vec_id
QUALIFY rank <= 20
""",
}
