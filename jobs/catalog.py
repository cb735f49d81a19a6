"""The jobs as registered queries, each run twice into one new folder, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import condition_report, source_ledger
from transect.plans.catalog import PRESET_SQL, q6, r6
from transect.plans.files import new_folder

HERE = Path(__file__).resolve().parent


def job1_condition_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of all embeddings as profiles, placed on the track of the events."""
    config, out = condition_report.Config.load(str(HERE / "condition_report.json")), new_folder(spark, "condition-report")
    for _ in range(2):
        condition_report.run(spark, f"{sf_dir}/embeddings.parquet", f"{sf_dir}/events.parquet", out, config)
    # A place between two events has up to eight digits, of which rounding to six could meet a half.
    exact, chainage = ("set_id", "profile", "frame", "state", "severity"), F.round("chainage", 9).alias("chainage")
    return condition_report.ratings_of(spark, out, config).select(*exact, chainage, *[r6(c).alias(c) for c in ("cs_percent", "left_depth", "right_depth", "depth")])


JOB1_SQL = (
    PRESET_SQL
    + ", slope AS (SELECT profile, 100.0 * (avg(y) FILTER (x <= 81.5) - avg(y) FILTER (x >= 81.5)) / ((max(x) - min(x)) / 2) AS cs FROM kept GROUP BY profile)"
    + ", track AS (SELECT CAST(user_id % 10 AS VARCHAR) AS set_id, CAST(event_id AS DOUBLE) AS f, value AS v, lead(CAST(event_id AS DOUBLE)) OVER o AS f1, lead(value) OVER o AS v1 FROM events WINDOW o AS (PARTITION BY user_id % 10 ORDER BY event_id))"
    + ", rows_ AS (SELECT file AS set_id, profile, profile * 20.0 + 7.5 AS frame, ok, ld, rd, (ld + rd) / 2 AS d FROM row_)"
    + f" SELECT r.set_id, profile, CAST(frame AS DOUBLE) AS frame, CASE WHEN ok THEN 'ok' ELSE 'error' END AS state, CASE WHEN d IS NULL THEN -1 WHEN d < 0.25 THEN 0 WHEN d < 0.5 THEN 1 WHEN d < 1.0 THEN 2 ELSE 3 END AS severity, round(v + (frame - f) / (f1 - f) * (v1 - v), 9) AS chainage,"
    + f" {q6('cs')} AS cs_percent, {q6('ld')} AS left_depth, {q6('rd')} AS right_depth, {q6('d')} AS depth FROM rows_ r LEFT JOIN slope USING (profile) LEFT JOIN track t ON r.set_id = t.set_id AND frame >= f AND frame < f1"
)


def job2_source_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger entries of all documents, newest of each."""
    config, out = source_ledger.Config.load(str(HERE / "source_ledger.json")), new_folder(spark, "source-ledger")
    for _ in range(2):
        source_ledger.run(spark, f"{sf_dir}/documents.parquet", f"{out}/ledger", f"{out}/checkpoint", config)
    return source_ledger.current(source_ledger.ledger_of(spark, f"{out}/ledger", config)).withColumnRenamed("key", "doc_id")


def _little(n: str) -> str:
    """Hex of a number as eight bytes, the least first; numbers below 2 ** 32."""
    return "printf('%02x%02x%02x%02x00000000', {0} % 256, {0} // 256 % 256, {0} // 65536 % 256, {0} // 16777216)".format(f"CAST({n} AS BIGINT)")


def _part(at: str) -> str:
    return f"{_little(at)} || {_little('least(n, 4096)')} || substr(h, CAST(2 * ({at}) + 1 AS BIGINT), 8192)"


_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
JOB2_SQL = (
    "WITH d AS (SELECT source, doc_id, text, hex(encode(text)) AS h, octet_length(encode(text)) AS n FROM documents), "
    + f"e AS (SELECT source, doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D][^\\n]*')) AS BIGINT) AS n_lines, CAST(len({_WORDS}) AS BIGINT) AS n_words, "
    + f"CAST(len(list_filter({_WORDS}, lambda w: regexp_full_match(w, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'))) AS BIGINT) AS n_numbers, "
    + "CASE WHEN n IS NOT NULL THEN sha256(encode('probe:' || n || ':') || unhex("
    + f"{_part('0')} || CASE WHEN n > 4097 THEN {_part('(n - 4096) // 2')} ELSE '' END || CASE WHEN n > 4096 THEN {_part('n - 4096')} ELSE '' END)) END AS probe FROM d) "
    + "SELECT source, doc_id, n_bytes, n_lines, n_words, n_numbers, probe, CAST(1 AS BIGINT) AS n_entries, FALSE AS changed FROM e"
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries by name."""
    return {f.__name__: f for f in (job1_condition_report, job2_source_ledger)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return {"job1_condition_report": JOB1_SQL, "job2_source_ledger": JOB2_SQL}
