"""The registered queries opN_<name> of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transect.llm import chat, decontaminate, fim, langid, lm, mixing, packing, pii, quality, secret_scan, simhash, token_counts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and the verdict of each document; the forest is fit on at most 8,192 labelled rows."""
    docs = table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in each document."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


OP2_SQL = r"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (SELECT k, size, i, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT k, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size)),
met AS (SELECT DISTINCT r.k, r.i, r.size, x.item_id FROM runs r JOIN windows x ON r.size = x.size AND r.s = x.s),
hit AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + size)) AS p FROM met) GROUP BY k),
found AS (SELECT k, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM met GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (k) LEFT JOIN found USING (k)
""".replace("\\\\", "\\")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, and of number -7, whose texts hold control strings."""
    text = r"\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], turns.schema)
    return chat.digests(chat.formatted(turns.unionByName(planted)))


_ESCAPED = r"""length(regexp_replace(text, '(\\|###|</turn>)', 'x\1', 'g'))"""
OP3_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_ESCAPED} + length(regexp_replace(role, '(\\|###|</turn>|:)', 'x\1', 'g')) + 15) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS rewrites
FROM t GROUP BY conv_id
"""


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document, found by scanning flat token files for separators."""
    return token_counts.counted(table(spark, sf_dir, "documents"))


def op5_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of the sources takes of each document."""
    return mixing.Mix(table(spark, sf_dir, "documents")).documents().select("doc_id", "size", "source_size", "target", "taken")


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each document: counts of the base kinds, digest of their spans, all spans."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.RULES[:3]]

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *[count(k) for k in base],
        F.sha2(listed(F.filter("spans", lambda s: s["order"] < 3)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def remainder() -> Column:
    """crc32 of the doc_id as text, modulo 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder() == 0)
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.predicted(docs, model, ["doc_id", "held_out"])


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of each document under a Kneser-Ney model of those that aren't held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder() == 1)
    model = lm.train(docs.filter(~F.col("held_out")))
    return lm.scored(docs, model, ["doc_id", "held_out"])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document: counts of the base kinds, digest of their spans, all spans."""
    docs = table(spark, sf_dir, "documents")
    found = pii.detected(docs, pii.train(docs))
    names = F.array(*[F.lit(k) for k in pii.KINDS])

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{pii.KINDS[kind]}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select("doc_id", *[count(k) for k in range(len(pii.KINDS))], F.sha2(listed(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of each document: digests of the output and of the text restored from it."""
    done = fim.transformed(table(spark, sf_dir, "documents"))
    text = fim.restored(F.col("form"), F.col("output"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4,096 tokens."""
    pieces = packing.pieces_of(packing.packed(table(spark, sf_dir, "documents")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries by name."""
    return {f.__name__: f for f in (op1_quality_rules, op2_benchmark_decontamination, op3_chat_formatting, op4_token_counts, op5_mixing_sources, op6_secret_scans, op7_simhash_near_dedup, op8_language_id, op9_lm_scoring, op10_pii, op11_fill_in_middle, op12_packing)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return {"op2_benchmark_decontamination": OP2_SQL, "op3_chat_formatting": OP3_SQL, "op6_secret_scans": secret_scan.SQL, "op11_fill_in_middle": fim.SQL}
