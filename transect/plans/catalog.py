"""Registered queries of the survey operators, named by operator, and their DuckDB SQL.

Doubles are rounded to six places on both sides, because engines add in different orders; adding 0.0 turns -0.0 into 0.0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transect.config import Lane, Options, Reduction
from transect.functions import scalars
from transect.operators import arrays, hulls
from transect.operators.measure import aggregate_files, measure_profiles, profile_parts, reduce_profiles
from transect.plans import batch, maps, sets
from transect.plans.checkpoint import Checkpoint, probe
from transect.plans.export import export_rows, write_csv, write_geojson
from transect.plans.files import new_folder, put_files
from transect.plans.adapters import profiles, sample_sql, table
from transect.plans.ranking import running_number
from transect.sources import calibration, datasource, records, survey

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
LANE, OFF_GRID = Lane(0.0, 162.0), Lane(0.0, 162.0, 0.5)
#: Raw profiles, taken as they are: no outlier filter and no smoothing.
PLAIN = Reduction()


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    """Queries by name."""
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smooth every profile, measure it, and aggregate by file."""
    return survey_preset(spark, sf_dir)


def r6(value: Column | str) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, 6) + 0.0


def q6(value: str) -> str:
    return f"round({value}, 6) + 0.0"


# Sources


@query("SELECT CAST(c_custkey % 40 + 1 AS VARCHAR) AS set_id, count(*) AS n_files FROM customer WHERE c_custkey % 3 <> 0 GROUP BY 1")
def s1_discover_sets(spark, sf_dir):
    path = F.concat(F.lit("file:/survey/"), F.when(F.col("c_custkey") % 3 == 0, F.lit("notes")).otherwise((F.col("c_custkey") % 40 + 1).cast("string")), F.lit("/93/"), F.col("c_custkey"), F.lit(".3dc"))
    return survey.sets_of(table(spark, sf_dir, "customer").select(path.alias("path")), "/survey")


_STEM = "printf('%02d%02d%02d%02dC', hour(ts), minute(ts), second(ts), CAST(floor((microsecond(ts) % 1000000) * 30 / 1000000.0) AS INT))"


def _image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(set_id, relative_path): a file name with a time code for each event; the user is the set."""
    ts = F.col("ts")
    frames = F.floor((F.date_format(ts, "SSSSSS").cast("int")) * 30 / 1000000.0).cast("int")
    stem = F.format_string("%02d%02d%02d%02dC", F.hour(ts), F.minute(ts), F.second(ts), frames)
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("set_id"), F.concat(F.lit("93/"), stem, F.lit("_"), F.col("event_id"), F.lit(".3dc")).alias("relative_path"), stem.alias("stem"))


@query(f"SELECT CAST(user_id AS VARCHAR) AS set_id, event_id, {_STEM} AS stem, CAST(((hour(ts) * 60 + minute(ts)) * 60 + second(ts)) * 30 + floor((microsecond(ts) % 1000000) * 30 / 1000000.0) AS DOUBLE) AS frame FROM events")
def p1_timecode_frame(spark, sf_dir):
    names = _image_names(spark, sf_dir)
    return names.select("set_id", F.regexp_extract("relative_path", "_([0-9]+)[.]", 1).cast("bigint").alias("event_id"), "stem", scalars.frame_of(F.col("stem")).alias("frame"))


_INDEX = f"""named AS (SELECT CAST(user_id AS VARCHAR) AS set_id, '93/' || {_STEM} || '_' || event_id || '.3dc' AS relative_path,
  CAST(((hour(ts) * 60 + minute(ts)) * 60 + second(ts)) * 30 + floor((microsecond(ts) % 1000000) * 30 / 1000000.0) AS DOUBLE) AS start_frame FROM events),
stepped AS (SELECT *, lead(start_frame) OVER (PARTITION BY set_id ORDER BY start_frame, lower(relative_path), relative_path) AS nxt FROM named),
usual AS (SELECT set_id, coalesce(median(nxt - start_frame) FILTER (nxt > start_frame), 1.0) AS usual FROM stepped GROUP BY set_id)"""


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.end_frames(_image_names(spark, sf_dir).select("set_id", "relative_path", scalars.frame_of(F.col("stem")).alias("start_frame")))


@query(f"WITH {_INDEX} SELECT set_id, relative_path, start_frame, CASE WHEN nxt > start_frame THEN nxt ELSE start_frame + usual END AS end_frame FROM stepped JOIN usual USING (set_id)")
def w9_index_end_frame(spark, sf_dir):
    return _index(spark, sf_dir)


@query(f"WITH {_INDEX} SELECT set_id, usual AS median_step FROM usual")
def a13_median_step(spark, sf_dir):
    rows = _index(spark, sf_dir)
    last = rows.groupBy("set_id").agg(F.max_by(F.struct("start_frame", "end_frame"), F.struct("start_frame", "relative_path")).alias("e"))
    return last.select("set_id", (F.col("e.end_frame") - F.col("e.start_frame")).alias("median_step"))


_ONE_SET = _INDEX.replace("CAST(user_id AS VARCHAR) AS set_id", "'0' AS set_id")


@query(
    f"WITH {_ONE_SET}, ranked AS (SELECT *, row_number() OVER (ORDER BY start_frame, lower(relative_path), relative_path) AS k FROM stepped WHERE start_frame BETWEEN 100000 AND 2000000) "
    "SELECT relative_path, start_frame, CASE WHEN nxt > start_frame THEN nxt ELSE start_frame + usual END AS end_frame FROM ranked JOIN usual USING (set_id) WHERE k <= 1000"
)
def f7_select_files(spark, sf_dir):
    """The first 1,000 files of a frame range, all events taken as one set; the limit is the operator's."""
    names = _image_names(spark, sf_dir).select(F.lit("0").alias("set_id"), "relative_path", scalars.frame_of(F.col("stem")).alias("start_frame"))
    return survey.select_files(survey.end_frames(names), 100000, 2000000, 1000).drop("set_id")


def _block(total: Column, payload: Column, flags: int = 0x46) -> Column:
    """A QuickLZ block with the long header around a payload (hex) that stands for `total` bytes; uncompressed unless the flags say otherwise."""

    def little(n: Column, width: int) -> Column:
        return F.concat(*[F.lpad(F.hex(F.shiftright(n.cast("int"), 8 * k).bitwiseAND(255)), 2, "0") for k in range(width)])

    return F.unhex(F.concat(F.lit(f"{flags:02x}"), little((F.length(payload) / 2).cast("int") + 9, 4), little(total, 4), payload))


@query("SELECT s_suppkey, CAST(f AS BIGINT) AS flags, CASE WHEN f & 2 > 0 THEN 9 ELSE 3 END AS size, c % (CASE WHEN f & 2 > 0 THEN 4294967296 ELSE 256 END) AS compressed, d % (CASE WHEN f & 2 > 0 THEN 4294967296 ELSE 256 END) AS decompressed, (f >> 2) & 3 AS level, (f >> 4) & 3 AS streaming, f & 1 = 1 AS is_compressed FROM (SELECT s_suppkey, s_suppkey * 7 % 256 AS f, s_suppkey * 1009 AS c, s_suppkey * 31 AS d FROM supplier)")
def s5_quicklz_header(spark, sf_dir):
    def little(n, width):
        return F.concat(*[F.lpad(F.hex(F.shiftright(n, 8 * k).bitwiseAND(255)), 2, "0") for k in range(width)])

    k = F.col("s_suppkey")
    f = k * 7 % 256
    wide = F.unhex(F.concat(F.lpad(F.hex(f), 2, "0"), little(k * 1009, 4), little(k * 31, 4)))
    short = F.unhex(F.concat(F.lpad(F.hex(f), 2, "0"), little(k * 1009, 1), little(k * 31, 1)))
    head = records.header_columns(F.when(f.bitwiseAND(2) != 0, wide).otherwise(short))
    return table(spark, sf_dir, "supplier").select("s_suppkey", head.alias("h")).select("s_suppkey", "h.*")


_LETTERS = "chr(CAST(97 + s_suppkey % 26 AS INT)) || chr(CAST(65 + s_suppkey * 7 % 26 AS INT)) || chr(CAST(48 + s_suppkey * 3 % 10 AS INT))"


@query(f"SELECT s_suppkey, substr(repeat({_LETTERS}, 10), 1, CAST(5 + s_suppkey % 15 + 1 AS INT)) || printf('%011d', s_suppkey) AS text FROM supplier")
def s6_quicklz_decompress(spark, sf_dir):
    """A compressed block for each supplier: three letters, a match of 3 to 17 bytes that repeats itself, eleven digits."""
    k = F.col("s_suppkey")

    def byte(n):
        return F.lpad(F.hex(n.cast("int").bitwiseAND(255)), 2, "0")

    a, b, c = 97 + k % 26, 65 + k * 7 % 26, 48 + k * 3 % 10
    fetch = (a + b * 256 + c * 65536).cast("int")
    more = (k % 15 + 1).cast("int")  # a match's length less two
    match = F.shiftleft(F.shiftright(fetch, 12).bitwiseXOR(fetch).bitwiseAND(4095), 4) + more
    body = F.concat(F.lit("08000080"), byte(a), byte(b), byte(c), byte(match), byte(F.shiftright(match, 8)), F.hex(F.format_string("%011d", k).cast("binary")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", records.decompressed(_block(more + 16, body, 0x47)).cast("string").alias("text"))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content): a file of two profiles with four columns for each supplier."""

    def byte(n):
        return F.lpad(F.hex(n.bitwiseAND(255)), 2, "0")

    k = F.col("s_suppkey")
    profile = [F.concat(F.lit("4845414445523031"), *[byte(k + p + c) for c in range(4)], *[F.concat(byte(k * 10 + p * 100 + c), byte(F.shiftright(k * 10 + p * 100 + c, 8))) for c in range(4)]) for p in range(2)]
    return table(spark, sf_dir, "supplier").select(k.cast("string").alias("path"), _block(F.lit(40), F.concat(*profile)).alias("content"))


_IMAGE_SQL = "SELECT CAST(s_suppkey AS VARCHAR) AS path, CAST(p AS INT) AS row_index, [CAST((s_suppkey * 10 + p * 100 + c) % 65536 AS INT) FOR c IN [3, 2, 1, 0]] AS h FROM supplier, (SELECT unnest([0, 1]) AS p)"


@query(f"SELECT path, row_index, array_to_string(h, ',') AS heights FROM ({_IMAGE_SQL})")
def s8_threedc_decode(spark, sf_dir):
    return records.profiles(_images(spark, sf_dir), columns=4).select("path", "row_index", F.array_join(F.col("raw_heights").cast("array<string>"), ",").alias("heights"))


@query(f"SELECT path, row_index, array_to_string(h, ',') AS heights FROM ({_IMAGE_SQL}) WHERE row_index = 1")
def s9_profile_at(spark, sf_dir):
    rows = records.profiles(_images(spark, sf_dir), columns=4).select("path", "row_index", F.array_join(F.col("raw_heights").cast("array<string>"), ",").alias("heights"))
    return records.profile_at(rows, -1)


_TICKS = "s_suppkey * 7"
_FILES = (
    f"file AS (SELECT s_suppkey, CAST(s_suppkey % 5 AS VARCHAR) AS set_id, '93/' || printf('%02d%02d%02d%02dC', t // 108000, t // 1800 % 60, t // 30 % 60, t % 30) || '.3dc' AS relative_path, CAST(t AS DOUBLE) AS start_frame FROM (SELECT s_suppkey, CAST({_TICKS} AS BIGINT) AS t FROM supplier))"
)


def _survey(spark: SparkSession, sf_dir: str) -> str:
    """A survey on disk, written by tasks: the image of each supplier under one of five sets, and a calibration of each region as that of a set."""
    root, t = new_folder(spark, "survey"), F.expr(f"CAST({_TICKS} AS BIGINT)")
    name = F.format_string("%02d%02d%02d%02dC.3dc", F.floor(t / 108000), F.floor(t / 1800) % 60, F.floor(t / 30) % 60, t % 30)
    images = _images(spark, sf_dir).withColumn("s_suppkey", F.col("path").cast("bigint")).select(F.concat(F.lit(f"{root}/"), (F.col("s_suppkey") % 5).cast("string"), F.lit("/93/"), name).alias("path"), "content")
    k = F.col("r_regionkey")
    words = [F.lit("3D_Camera_Calibration -1.5 0 2.5"), k * 10, k % 7 + 1.5, k % 5 + 2.25, k % 9 + 20.0, F.lit("162 0.03 0.03"), k % 11 + 10.0, F.lit("0.125 2020 1 2 3 4")]
    text = table(spark, sf_dir, "region").select(F.concat(F.lit(f"{root}/"), k.cast("string"), F.lit("/3D_Camera.cal")).alias("path"), F.concat_ws(" ", *[w.cast("string") for w in words]).cast("binary").alias("content"))
    put_files(images.unionByName(text)).write.format("noop").mode("overwrite").save()
    return root


@query(
    f"WITH {_FILES}, n AS (SELECT *, lead(start_frame) OVER (PARTITION BY set_id ORDER BY start_frame) AS nxt FROM file), u AS (SELECT set_id, coalesce(median(nxt - start_frame), 1.0) AS usual FROM n GROUP BY set_id) "
    "SELECT set_id, relative_path, start_frame, coalesce(nxt, start_frame + usual) AS end_frame FROM n JOIN u USING (set_id)"
)
def s2_survey_index(spark, sf_dir):
    """The index of all sets of a survey on disk, from names alone."""
    return sets.survey_index(spark, _survey(spark, sf_dir))


@query(
    f"WITH {_FILES}, chosen AS (SELECT *, row_number() OVER (ORDER BY set_id, start_frame) - 1 AS k FROM file WHERE set_id >= '1' AND set_id <= '3' AND start_frame > 50) "
    "SELECT set_id, relative_path, start_frame, CAST(k AS INT) AS file_number, CAST(p AS INT) AS row_index, CAST(49 AS BIGINT) AS length, array_to_string([CAST((s_suppkey * 10 + p * 100 + c) % 65536 AS INT) FOR c IN [3, 2, 1, 0]], ',') AS heights FROM chosen, (SELECT unnest([0, 1]) AS p)"
)
def s8_survey_source(spark, sf_dir):
    """Profiles of some sets and frames by the data source; file_number counts the files that are opened."""
    rows = datasource.read_survey(spark, _survey(spark, sf_dir), ["1", "2", "3"], from_frame=51, columns=4, split_bytes=1000)
    return rows.select("set_id", "relative_path", "start_frame", "file_number", "row_index", "length", F.array_join(F.col("raw_heights").cast("array<string>"), ",").alias("heights"))


@query(
    f"WITH {_FILES}, cal AS (SELECT CAST(k AS VARCHAR) AS set_id, [-1.5, 0.0, 2.5, k * 10.0] AS o, (162.0 / 4) * sqrt(ch * ch + cz * cz) * lz / (16.0 * (ch * lz + lh * cz)) AS r FROM (SELECT r_regionkey AS k, r_regionkey % 7 + 1.5 AS ch, r_regionkey % 5 + 2.25 AS lh, r_regionkey % 9 + 20.0 AS cz, r_regionkey % 11 + 10.0 AS lz FROM region)) "
    f"SELECT set_id, relative_path, CAST(p AS INT) AS row_index, CAST(i AS INT) AS i, {q6('i * 40.5')} AS x, {q6('((s_suppkey * 10 + p * 100 + 3 - i) % 65536 - o[i + 1]) * r')} AS y FROM file JOIN cal USING (set_id), (SELECT unnest([0, 1]) AS p), (SELECT unnest([0, 1, 2, 3]) AS i)"
)
def j1_calibrated_sets(spark, sf_dir):
    """Profiles of five sets in one scan, each with the calibration of its set."""
    root = _survey(spark, sf_dir)
    rows = sets.calibrated_profiles(datasource.read_survey(spark, root, columns=4), sets.set_calibrations(spark, root, 4))
    return arrays.points(rows, ["set_id", "relative_path", "row_index"]).select("set_id", "relative_path", "row_index", "i", r6("x").alias("x"), r6("y").alias("y"))


_CAL = "s_suppkey % 7 + 1.5 AS ch, s_suppkey % 5 + 2.25 AS lh, s_suppkey % 9 + 20.0 AS cz, 162.0 AS w, s_suppkey % 11 + 10.0 AS lz"


@query(f"SELECT CAST(s_suppkey AS VARCHAR) AS path, w / 4 AS pixel_width, {q6('(w / 4) * sqrt(ch * ch + cz * cz) * lz / (16.0 * (ch * lz + lh * cz))')} AS resolution, make_timestamp(2020, 1 + s_suppkey % 12, 1 + s_suppkey % 28, 3, 4, 0.0) AS calibrated_at, 1 AS n_extra FROM (SELECT s_suppkey, {_CAL} FROM supplier) WHERE s_suppkey % 10 NOT IN (0, 3, 6)")
def s10_calibrations(spark, sf_dir):
    """Calibration records; those with another header, an infinite value or a year with a fraction are refused."""
    k = F.col("s_suppkey")
    words = [F.lit("3D_Camera_Calibration"), F.lit("-1.5 0 2.5 10"), k % 7 + 1.5, k % 5 + 2.25, k % 9 + 20.0, F.lit("162 0.03 0.03"), k % 11 + 10.0, F.lit("0.125 2020"), 1 + k % 12, 1 + k % 28, F.lit("3 4 7.5")]
    text = F.concat_ws(" \n", *[w.cast("string") for w in words])
    text = F.when(k % 10 == 0, F.lit("other 1 2 3")).when(k % 10 == 3, F.replace(text, F.lit("0.03"), F.lit("Infinity"))).when(k % 10 == 6, F.replace(text, F.lit(" 2020"), F.lit(" 2020.5"))).otherwise(text)
    got = calibration.calibrations_of(table(spark, sf_dir, "supplier").select(k.cast("string").alias("path"), text.alias("value")), columns=4)
    return got.select("path", (F.col("pavement_width") / 4).alias("pixel_width"), r6("resolution").alias("resolution"), "calibrated_at", F.size("extra").alias("n_extra"))


@query("SELECT c_custkey AS line, round(c_acctbal, 2) AS second, 4 AS n FROM customer WHERE c_custkey % 3 = 0")
def s11_numeric_rows(spark, sf_dir):
    k = F.col("c_custkey")
    value = F.when(k % 3 == 0, F.concat_ws("  ", F.lit(" "), k, F.round("c_acctbal", 2), F.lit("3 -4e1"))).when(k % 3 == 1, F.concat_ws(" ", k, F.col("c_name"), F.lit("1 2"))).otherwise(F.concat_ws(" ", k, F.lit("5")))
    return survey.numbers_of(table(spark, sf_dir, "customer").select(k.alias("line"), value.alias("value")), 4).select("line", F.get("v", F.lit(1)).alias("second"), F.size("v").alias("n"))


# Scalars


@query("SELECT l_orderkey, l_linenumber, CASE WHEN d < 0.25 THEN 0 WHEN d < 0.5 THEN 1 WHEN d < 1.0 THEN 2 ELSE 3 END AS severity FROM (SELECT *, abs(l_discount) * 12 AS d FROM lineitem)")
def p12_severity(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scalars.severity(F.abs("l_discount") * 12).alias("severity"))


@query("SELECT c_custkey, CASE WHEN c_acctbal / 5000 < 0.25 THEN 0 WHEN c_acctbal / 5000 < 0.5 THEN 1 WHEN c_acctbal / 5000 < 1.0 THEN 2 ELSE 3 END AS severity FROM customer")
def p13_severity_lenient(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", scalars.severity(F.col("c_acctbal") / 5000, allow_negative=True).alias("severity"))


_LANE = "SELECT l_orderkey, l_linenumber, l_quantity AS l, l_quantity + 40 + l_tax * 1000 AS r, (2 * l_quantity + 40 + l_tax * 1000) / 2 AS c FROM lineitem"


@query(
    f"SELECT l_orderkey, l_linenumber, {q6('c')} AS center, {q6('c - 34.448819')} AS wheel_left, {q6('c + 34.448819')} AS wheel_right, {q6('greatest(l, c - 34.448819 - 22.14567)')} AS zone_low, {q6('least(c, c - 34.448819 + 22.14567)')} AS zone_high, "
    f"{q6('greatest(c, c + 34.448819 - 22.14567)')} AS right_low, {q6('least(r, c + 34.448819 + 22.14567)')} AS right_high, FALSE AS refused FROM ({_LANE}) WHERE l_quantity_ok(l) "
    f"UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL, NULL, NULL, NULL, NULL, NULL, TRUE FROM ({_LANE}) WHERE NOT l_quantity_ok(l)".replace("l_quantity_ok(l)", "(CAST(l AS INT) % 7 <> 0)")
)
def p6_lane_geometry(spark, sf_dir):
    """Lane's own numbers for each pair of edges that there is (P6); edges the wrong way round are refused."""
    import pandas as pd

    def lanes(batches):
        for b in batches:
            rows = []
            for left, right in zip(b["l"], b["r"], strict=True):
                try:
                    x = Lane(left, right) if int(left) % 7 else Lane(right, left)
                    rows.append((left, right, x.center, x.wheel_center("left"), x.wheel_center("right"), *x.wheel_zone("left"), *x.wheel_zone("right"), False))
                except ValueError:
                    rows.append((left, right, *[None] * 7, True))
            yield pd.DataFrame(rows, columns=["l", "r", *names, "refused"])

    names = ["center", "wheel_left", "wheel_right", "zone_low", "zone_high", "right_low", "right_high"]
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("l"), (F.col("l_quantity") + 40 + F.col("l_tax") * 1000).cast("double").alias("r"))
    found = items.select("l", "r").distinct().mapInPandas(lanes, "l double, r double, " + ", ".join(f"{n} double" for n in names) + ", refused boolean")
    return items.join(found, ["l", "r"]).select("l_orderkey", "l_linenumber", *[r6(n).alias(n) for n in names], "refused")


@query(f"SELECT o_orderkey, {q6('CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN (o_totalprice + o_custkey) / 2 END')} AS overall FROM orders")
def p11_overall(spark, sf_dir):
    left = F.when(F.col("o_orderkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    right = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey").cast("double"))
    return table(spark, sf_dir, "orders").select("o_orderkey", r6(scalars.overall(left, right)).alias("overall"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS value FROM orders")
def p18_json_safe(spark, sf_dir):
    odd = F.when(F.col("o_orderkey") % 8 == 0, F.lit(float("nan"))).when(F.col("o_orderkey") % 8 == 4, F.lit(float("inf"))).otherwise(F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.finite(odd).alias("value"))


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 2 THEN 'moderate_' || p_partkey || '_' || p_size || '_x.png' WHEN p_size % 4 = 3 THEN 'high_' || p_partkey || '_' || p_size || '_x.png' END AS preview FROM part")
def p20_preview_name(spark, sf_dir):
    name = F.concat(F.col("p_size"), F.lit("_x.3dc"))
    return table(spark, sf_dir, "part").select("p_partkey", scalars.preview_name(F.col("p_size") % 4, F.col("p_partkey").cast("double"), name).alias("preview"))


@query("SELECT o_orderkey, printf('%02d:%02d:%02d', t // 3600, t // 60 % 60, t % 60) AS duration FROM (SELECT o_orderkey, CAST(round_even(o_totalprice, 0) AS BIGINT) AS t FROM orders)")
def p21_duration(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.duration(F.col("o_totalprice")).alias("duration"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'previews/' || p_size || '.png' ELSE '/elsewhere/' || p_size || '.png' END AS link FROM part")
def p22_relative_preview(spark, sf_dir):
    path = F.concat(F.when(F.col("p_partkey") % 2 == 0, F.lit("/out/set_1/previews/")).otherwise(F.lit("/elsewhere/")), F.col("p_size"), F.lit(".png"))
    return table(spark, sf_dir, "part").select("p_partkey", maps.relative_preview(path, "/out/set_1").alias("link"))


@query(
    f"WITH {sample_sql(8.0)}, lim AS (SELECT file, quantile_cont(y, 0.02) AS lo, quantile_cont(y, 0.98) AS hi FROM sample GROUP BY file) "
    "SELECT file, profile, CAST(sum(CAST(round_even(least(greatest((y - lo) / (hi - lo), 0.0), 1.0) * 255.0, 0) AS INT)) AS BIGINT) AS gray FROM sample JOIN lim USING (file) GROUP BY file, profile"
)
def p14_grayscale(spark, sf_dir):
    rows = arrays.points(profiles(spark, sf_dir, 8.0), ["file", "profile"])
    limits = rows.groupBy("file").agg(F.percentile("y", F.array(F.lit(0.02), F.lit(0.98))).alias("p"))
    gray = scalars.grayscale(F.col("y"), F.get("p", F.lit(0)), F.get("p", F.lit(1)))
    return rows.join(limits, "file").groupBy("file", "profile").agg(F.sum(gray).alias("gray"))


@query("SELECT s_suppkey, 3 + s_suppkey % 11 AS width, 2 + s_suppkey % 7 AS height, CASE WHEN s_suppkey % 3 = 0 THEN 128 * (3 + s_suppkey % 11) * (2 + s_suppkey % 7) ELSE 255 * (((3 + s_suppkey % 11) * (2 + s_suppkey % 7)) // 2) END AS gray FROM supplier")
def p15_png_preview(spark, sf_dir):
    """An image of another size for each supplier, flat or half low and half high, encoded and read back."""
    import zlib

    import numpy as np
    import pandas as pd

    from transect.operators.preview import height_image, png

    def encoded(batches):
        for b in batches:
            rows = []
            for key in b["s_suppkey"].tolist():
                width, height = 3 + key % 11, 2 + key % 7
                heights = np.full(width * height, 7.0) if key % 3 == 0 else np.where(np.arange(width * height) < width * height - width * height // 2, 1.0, 2.0)
                body = png(height_image(heights.reshape(height, width)))
                at = body.index(b"IDAT")
                pixels = zlib.decompress(body[at + 4 : at + 4 + int.from_bytes(body[at - 4 : at], "big")])
                rows.append((key, int.from_bytes(body[16:20], "big"), int.from_bytes(body[20:24], "big"), sum(pixels)))
            yield pd.DataFrame(rows, columns=["s_suppkey", "width", "height", "gray"])

    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("s_suppkey")).mapInPandas(encoded, "s_suppkey bigint, width bigint, height bigint, gray bigint")


# Profile arrays


def _reduced(spark: SparkSession, sf_dir: str, reduction: Reduction, scale: float = 1.0, holes: bool = False) -> DataFrame:
    """Profiles as the kernel cleans them."""
    return reduce_profiles(profiles(spark, sf_dir, scale, holes), reduction, ["profile"])


@query(f"WITH {sample_sql(8.0)} SELECT profile, i, {q6('x')} AS x, {q6('(y - 0.01 * i) * 0.78125')} AS y FROM sample")
def p5_calibrate(spark, sf_dir):
    offsets = F.transform(F.sequence(F.lit(0), F.size("y") - 1), lambda i: i * 0.01)
    rows = profiles(spark, sf_dir, 8.0).withColumns({"y": calibration.calibrated(F.col("y"), offsets, F.lit(0.78125)), "x": arrays.grid(F.size("y"), F.lit(162.0) / F.size("y"))})
    return arrays.points(rows, ["profile"]).select("profile", "i", r6("x").alias("x"), r6("y").alias("y"))


@query(f"WITH {sample_sql()} SELECT profile, count(*) AS n, {q6('min(x)')} AS first_x, {q6('max(x)')} AS last_x, {q6('avg(y)')} AS mean_y FROM sample WHERE x BETWEEN 20.25 AND 121.5 GROUP BY profile")
def f1_crop(spark, sf_dir):
    got = arrays.crop(profiles(spark, sf_dir), 20.25, 121.5)
    return got.select("profile", F.size("x").cast("bigint").alias("n"), r6(F.array_min("x")).alias("first_x"), r6(F.array_max("x")).alias("last_x"), r6(arrays.mean(F.col("y"))).alias("mean_y"))


@query(f"WITH {sample_sql(1.0, True)} SELECT profile, {q6('count(y) * 1.0 / count(*)')} AS valid_fraction, count(y) * 1.0 / count(*) >= 0.9 AS enough FROM sample GROUP BY profile")
def f3_valid_fraction(spark, sf_dir):
    share = arrays.valid_fraction(F.col("y"))
    return profiles(spark, sf_dir, holes=True).select("profile", r6(share).alias("valid_fraction"), (share >= 0.9).alias("enough"))


@query(f"WITH {sample_sql()}, stat AS (SELECT profile, avg(y) AS m, stddev_samp(y) AS s FROM sample GROUP BY profile) SELECT profile, count(*) AS n, {q6('avg(y)')} AS mean_y FROM sample JOIN stat USING (profile) WHERE abs(y - m) <= 2.5 * s GROUP BY profile")
def f5_sigma_outliers(spark, sf_dir):
    got = arrays.within_sigma(profiles(spark, sf_dir), 2.5)
    return got.select("profile", F.size("y").cast("bigint").alias("n"), r6(arrays.mean(F.col("y"))).alias("mean_y"))


_INSIDE = f"WITH {sample_sql()} SELECT profile, count(*) AS n FROM sample WHERE x > 2.53125 AND x < 159.46875 GROUP BY profile"


@query(_INSIDE)
def f6_inside_lane(spark, sf_dir):
    return arrays.inside_lane(profiles(spark, sf_dir), Lane(2.53125, 159.46875)).select("profile", F.size("x").cast("bigint").alias("n"))


@query(
    f"WITH {sample_sql(8.0)}, w AS (SELECT profile, i, n, avg(x) OVER o AS x, avg(y) OVER o AS y, count(*) OVER o AS c FROM sample WINDOW o AS (PARTITION BY profile ORDER BY i ROWS BETWEEN 9 PRECEDING AND 9 FOLLOWING)) "
    f"SELECT profile, CAST(i - 9 AS INT) AS i, {q6('x')} AS x, {q6('y')} AS y FROM w WHERE c = 19 AND i < n - 10"
)
def w1_smooth(spark, sf_dir):
    return arrays.points(arrays.smoothed(profiles(spark, sf_dir, 8.0)), ["profile"]).select("profile", "i", r6("x").alias("x"), r6("y").alias("y"))


@query(
    f"WITH {sample_sql(1.0, True)}, g AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN x END IGNORE NULLS) OVER p AS lx, last_value(y IGNORE NULLS) OVER p AS ly, first_value(CASE WHEN y IS NOT NULL THEN x END IGNORE NULLS) OVER f AS hx, first_value(y IGNORE NULLS) OVER f AS hy FROM sample "
    "WINDOW p AS (PARTITION BY profile ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f AS (PARTITION BY profile ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) "
    f"SELECT profile, CAST(i AS INT) AS i, {q6('coalesce(y, CASE WHEN hx - lx <= 6.0 THEN ly + (x - lx) * ((hy - ly) / (hx - lx)) END)')} AS y FROM g"
)
def w2_gap_fill(spark, sf_dir):
    filled = arrays.gaps_filled(arrays.points(profiles(spark, sf_dir, holes=True), ["profile"]), ["profile"], 6.0)
    return filled.select("profile", "i", r6("y").alias("y"))


@query(f"WITH {sample_sql()}, b AS (SELECT profile, i // 30 AS k, stddev_samp(y) AS s FROM sample GROUP BY 1, 2 HAVING count(*) = 30) SELECT profile, {q6('median(s)')} AS noise, median(s) > 0.12 AS is_noisy FROM b GROUP BY profile")
def a10_batch_noise(spark, sf_dir):
    noise = arrays.batch_noise(F.col("y"))
    return profiles(spark, sf_dir).select("profile", r6(noise).alias("noise"), (noise > 0.12).alias("is_noisy"))


@query(
    f"WITH {sample_sql()}, t AS (SELECT s.profile, s.i, any_value(s.y) AS y, avg(r.y) AS m FROM sample s, (SELECT unnest(range(-4, 5)) AS o), sample r WHERE r.profile = s.profile AND r.i = CASE WHEN abs(s.i + o) > s.n - 1 THEN 2 * (s.n - 1) - abs(s.i + o) ELSE abs(s.i + o) END GROUP BY s.profile, s.i) "
    f"SELECT profile, {q6('sqrt(avg(pow(y - m, 2)))')} AS noise FROM t GROUP BY profile"
)
def a11_residual_noise(spark, sf_dir):
    """Mirrored running mean over nine samples."""
    return _reduced(spark, sf_dir, Reduction(noise_window=20.0)).select("profile", r6("noise").alias("noise"))


@query(f"WITH {sample_sql()}, f AS (SELECT *, first_value(x) OVER w AS x0, first_value(y) OVER w AS y0 FROM sample WINDOW w AS (PARTITION BY profile ORDER BY i)) SELECT profile, CAST(i AS INT) AS i, {q6('x0 + (x - x0) * cos(radians(2.0)) + (y - y0) * sin(radians(2.0))')} AS x, {q6('y0 - (x - x0) * sin(radians(2.0)) + (y - y0) * cos(radians(2.0))')} AS y FROM f")
def p8_roll(spark, sf_dir):
    return arrays.points(arrays.rolled(profiles(spark, sf_dir), 2.0), ["profile"]).select("profile", "i", r6("x").alias("x"), r6("y").alias("y"))


_SHOULDER = f"""{sample_sql(2.0)},
seg AS (SELECT *, abs((lead(y) OVER o - y) / (lead(x) OVER o - x)) AS s, count(*) FILTER (x < 81.0 - 0.35 * 162.0) OVER w AS ll, count(*) FILTER (x <= 81.0 + 0.35 * 162.0) OVER w - 1 AS rl FROM sample WINDOW o AS (PARTITION BY profile ORDER BY i), w AS (PARTITION BY profile)),
isl AS (SELECT *, sum(CASE WHEN s > 0.055 THEN 0 ELSE 1 END) OVER (PARTITION BY profile ORDER BY i) AS k FROM seg),
run AS (SELECT profile, k, min(i) AS a, max(i) AS b, any_value(ll) AS ll, any_value(rl) AS rl FROM isl WHERE s > 0.055 GROUP BY profile, k HAVING count(*) >= 5 AND max(s) >= 0.17),
cut AS (SELECT profile, max(b + 2) FILTER (a <= ll) AS start, min(a) FILTER (b >= rl) AS stop FROM run GROUP BY profile),
kept AS (SELECT s.* FROM sample s LEFT JOIN cut c ON s.profile = c.profile WHERE i >= coalesce(start, 0) AND i < coalesce(stop, 1000000) AND x > 0.0 AND x < 162.0)"""


def _trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays.shoulders_removed(arrays.points(profiles(spark, sf_dir, 2.0), ["file", "profile"]), ["file", "profile"], LANE, 162.0)


@query(f"WITH {_SHOULDER} SELECT profile, CAST(min(i) AS INT) AS first_i, CAST(max(i) AS INT) AS last_i, count(*) AS n FROM kept GROUP BY profile")
def w3_shoulder_trim(spark, sf_dir):
    return _trimmed(spark, sf_dir).groupBy("profile").agg(F.min("i").alias("first_i"), F.max("i").alias("last_i"), F.count("*").alias("n"))


_STEEP = _SHOULDER.replace(sample_sql(2.0), sample_sql(64.0))


@query(f"WITH {_STEEP} SELECT profile FROM (SELECT DISTINCT profile FROM sample) WHERE profile NOT IN (SELECT profile FROM kept)")
def w4_shoulder_empty(spark, sf_dir):
    """Profiles so steep that nothing is left between the shoulders, in columns."""
    rows = profiles(spark, sf_dir, 64.0)
    kept = arrays.shoulders_removed(arrays.points(rows, ["file", "profile"]), ["file", "profile"], LANE, 162.0)
    return rows.select("profile").join(kept.select("profile"), "profile", "left_anti")


@query(f"WITH {_STEEP} SELECT profile, CAST(coalesce(min(k.i), -1) AS INT) AS first_i, CAST(coalesce(max(k.i), -1) AS INT) AS last_i, count(k.i) AS n FROM (SELECT DISTINCT profile FROM sample) LEFT JOIN kept k USING (profile) GROUP BY profile")
def w4_shoulder_kernel(spark, sf_dir):
    """What the kernel keeps between the shoulders of steep profiles; nothing (-1) of some."""
    got = profile_parts(profiles(spark, sf_dir, 64.0), LANE, PLAIN, ["profile"])
    some = F.col("stop") > F.col("start")
    return got.select("profile", F.when(some, F.col("start")).otherwise(-1).alias("first_i"), F.when(some, F.col("stop") - 1).otherwise(-1).alias("last_i"), (F.col("stop") - F.col("start")).cast("bigint").alias("n"))


@query(_SQL["w3_shoulder_trim"])
def w3_shoulder_kernel(spark, sf_dir):
    got = profile_parts(profiles(spark, sf_dir, 2.0), LANE, PLAIN, ["profile"]).filter("stop > start")
    return got.select("profile", F.col("start").alias("first_i"), (F.col("stop") - 1).alias("last_i"), (F.col("stop") - F.col("start")).cast("bigint").alias("n"))


_CROSS = """part AS (SELECT profile, file, avg(y) FILTER (x <= {c}) AS yl, avg(y) FILTER (x >= {c}) AS yr, avg(x) FILTER (x <= {c}) AS xl, (max(x) - min(x)) / 2 AS run, avg(y) AS m, count(*) AS n FROM {t} WHERE x > 0.0 AND x < 162.0 GROUP BY profile, file),
fall AS (SELECT *, (yl - yr) / run AS f, yl + (yl - yr) / run * xl AS b FROM part),
fit AS (SELECT s.profile, sum(pow(y - b + f * x, 2)) AS rss, sum(pow(y - m, 2)) AS tss FROM {t} s JOIN fall USING (profile) WHERE x > 0.0 AND x < 162.0 GROUP BY s.profile)"""


@query(f"WITH {sample_sql(2.0)}, {_CROSS.format(c=81.5, t='sample')} SELECT profile, {q6('100 * f')} AS cs_percent, {q6('degrees(atan(f))')} AS cs_degrees, {q6('b')} AS cs_intercept, {q6('1.0 - rss / tss')} AS cs_r2, CAST(n AS INT) AS cs_points FROM fall JOIN fit USING (profile)")
def a7_cross_slope(spark, sf_dir):
    got = arrays.cross_slope(profiles(spark, sf_dir, 2.0), OFF_GRID)
    return got.select("profile", *[r6(c).alias(c) for c in ("cs_percent", "cs_degrees", "cs_intercept", "cs_r2")], "cs_points")


@query(f"WITH {sample_sql()} SELECT profile, {q6('coalesce(regr_slope(y, x), 0)')} AS slope FROM sample WHERE x BETWEEN 10.0 AND 150.0 GROUP BY profile")
def a9_slope_hint(spark, sf_dir):
    rows = profiles(spark, sf_dir)
    return rows.select("profile", r6(arrays.slope_hint(rows, Lane(10.0, 150.0))).alias("slope"))


@query(f"WITH {sample_sql()}, d AS (SELECT profile, n, lead(x) OVER (PARTITION BY profile ORDER BY i) - x AS dx FROM sample) SELECT profile, {q6('median(dx) * max(n)')} AS width FROM d GROUP BY profile")
def a12_nominal_width(spark, sf_dir):
    return profile_parts(profiles(spark, sf_dir), LANE, PLAIN, ["profile"]).select("profile", r6("width").alias("width"))


@query(_SQL["a9_slope_hint"])
def a9_slope_kernel(spark, sf_dir):
    return profile_parts(profiles(spark, sf_dir), Lane(10.0, 150.0), PLAIN, ["profile"]).select("profile", r6("hint").alias("slope"))


@query(_SQL["f1_crop"])
def f1_crop_kernel(spark, sf_dir):
    got = _reduced(spark, sf_dir, Reduction(crop_left=20.25, crop_right=121.5))
    return got.select("profile", F.size("x").cast("bigint").alias("n"), r6(F.array_min("x")).alias("first_x"), r6(F.array_max("x")).alias("last_x"), r6(arrays.mean(F.col("y"))).alias("mean_y"))


@query(_SQL["f5_sigma_outliers"])
def f5_sigma_kernel(spark, sf_dir):
    got = _reduced(spark, sf_dir, Reduction(sigma=2.5))
    return got.select("profile", F.size("y").cast("bigint").alias("n"), r6(arrays.mean(F.col("y"))).alias("mean_y"))


@query(_SQL["w1_smooth"])
def w1_smooth_kernel(spark, sf_dir):
    got = _reduced(spark, sf_dir, Reduction(smooth_points=19, drop_last_window=True), 8.0)
    return arrays.points(got, ["profile"]).select("profile", "i", r6("x").alias("x"), r6("y").alias("y"))


@query(_SQL["w2_gap_fill"].replace("SELECT profile, CAST(i AS INT) AS i, round(coalesce", "SELECT profile, round(x, 6) + 0.0 AS x, round(coalesce") + " WHERE y IS NOT NULL OR hx - lx <= 6.0")
def w2_gap_kernel(spark, sf_dir):
    """Samples that are there or filled; the kernel drops the rest."""
    got = _reduced(spark, sf_dir, Reduction(max_gap=6.0, min_valid_fraction=0.0), holes=True)
    return arrays.points(got, ["profile"]).select("profile", r6("x").alias("x"), r6("y").alias("y"))


@query(_SQL["a10_batch_noise"])
def a10_noise_kernel(spark, sf_dir):
    got = _reduced(spark, sf_dir, Reduction(noise_batch=30, max_noise=0.12))
    return got.select("profile", r6("noise").alias("noise"), "is_noisy")


@query(_SQL["p8_roll"])
def p8_roll_kernel(spark, sf_dir):
    return arrays.points(_reduced(spark, sf_dir, Reduction(roll_degrees=2.0)), ["profile"]).select("profile", "i", r6("x").alias("x"), r6("y").alias("y"))


@query(_SQL["p8_roll"].replace("first_value(x) OVER w AS x0, first_value(y) OVER w AS y0", "81.0 AS x0, max(CASE WHEN x = 81.0 THEN y END) OVER w AS y0").replace("PARTITION BY profile ORDER BY i", "PARTITION BY profile"))
def p8_roll_about(spark, sf_dir):
    """Turned about the surface at the lane's center, which is a sample."""
    return arrays.points(_reduced(spark, sf_dir, Reduction(roll_degrees=2.0, roll_reference=81.0)), ["profile"]).select("profile", "i", r6("x").alias("x"), r6("y").alias("y"))


_POLICY = f"WITH {sample_sql(1.0, True)}, v AS (SELECT profile, any_value(n) AS n, profile % 3 = 0 AS whole, count(y) AS good, max(i) FILTER (y IS NOT NULL) - min(i) FILTER (y IS NOT NULL) + 1 AS span FROM sample GROUP BY profile)"


@query(
    f"{_POLICY} SELECT profile, policy, CAST(coalesce(CASE WHEN whole THEN n WHEN good < 0.9 * n OR policy = 'raise' THEN NULL ELSE CASE WHEN (CASE policy WHEN 'drop' THEN good ELSE span END) >= 59 THEN (CASE policy WHEN 'drop' THEN good ELSE span END) END END, -1) AS BIGINT) AS points "
    "FROM v, (SELECT unnest(['interpolate', 'drop', 'raise']) AS policy)"
)
def f4_invalid_policy(spark, sf_dir):
    """Points that each policy leaves of profiles with and without holes, -1 where too few are valid (F3) or left (F2) or holes aren't allowed."""
    rows = profiles(spark, sf_dir, holes=True).withColumn("whole", F.col("profile") % 3 == 0)
    rows = rows.withColumn("y", F.when(F.col("whole"), F.transform("y", lambda v: F.coalesce(v, F.lit(0.0)))).otherwise(F.col("y")))
    each = [reduce_profiles(rows, Reduction(invalid_policy=p, min_valid_fraction=0.9, min_points=59), ["profile"]).select("profile", F.lit(p).alias("policy"), F.size("x").cast("bigint").alias("points")) for p in ("interpolate", "drop", "raise")]
    out = each[0].unionByName(each[1]).unionByName(each[2])
    return out.withColumn("points", F.when(F.col("points") >= 0, F.col("points")).otherwise(-1).cast("bigint"))


@query(f"WITH {sample_sql(0.5)}, b AS (SELECT profile, i // 30 AS k, stddev_samp(y) AS s FROM sample GROUP BY 1, 2 HAVING count(*) = 30) SELECT CAST(profile AS INT) AS profile, CASE WHEN median(s) > 0.06 THEN 'skipped' ELSE 'ok' END AS state FROM b GROUP BY profile")
def f8_skip_noisy(spark, sf_dir):
    got = measure_profiles(_raw(spark, sf_dir, 0.5), OFF_GRID, Reduction(noise_batch=30, max_noise=0.06), Options(skip_noisy=True))
    return got.select(F.col("row_index").alias("profile"), "state")


def _lines(side: str, lane: Lane, scale: float) -> str:
    c, (low, high) = lane.wheel_center(side), lane.half(side)
    return (
        f"{side}_chord AS (SELECT a.profile, a.x AS ax, b.x AS bx, a.y AS ay, (b.y - a.y) / (b.x - a.x) AS m, a.y + (b.y - a.y) / (b.x - a.x) * ({c} - a.x) AS h, row_number() OVER (PARTITION BY a.profile ORDER BY a.y + (b.y - a.y) / (b.x - a.x) * ({c} - a.x) DESC, a.x, b.x DESC) AS k "
        f"FROM sample a JOIN sample b ON a.profile = b.profile AND a.x < {c} AND b.x >= {c} AND a.x >= {low} AND b.x <= {high} AND abs(a.x - {c}) <= 36.0 AND abs(b.x - {c}) <= 36.0)"
    )


@query(
    f"WITH {sample_sql()}, l AS (SELECT a.profile, max(a.y + (b.y - a.y) / (b.x - a.x) * ({LANE.wheel_center('left')} - a.x)) AS h FROM sample a JOIN sample b ON a.profile = b.profile AND a.x < {LANE.wheel_center('left')} AND b.x >= {LANE.wheel_center('left')} AND b.x <= 81.0 GROUP BY a.profile), "
    f"r AS (SELECT a.profile, max(a.y + (b.y - a.y) / (b.x - a.x) * ({LANE.wheel_center('right')} - a.x)) AS h FROM sample a JOIN sample b ON a.profile = b.profile AND a.x < {LANE.wheel_center('right')} AND a.x >= 81.0 AND b.x >= {LANE.wheel_center('right')} GROUP BY a.profile) "
    f"SELECT profile, {q6('l.h')} AS left_height, {q6('r.h')} AS right_height FROM l JOIN r USING (profile)"
)
def j8_support_line(spark, sf_dir):
    got = profile_parts(profiles(spark, sf_dir), LANE, PLAIN, ["profile"])
    return got.select("profile", r6("left_height").alias("left_height"), r6("right_height").alias("right_height"))


@query(
    f"WITH {sample_sql(8.0)}, up AS (SELECT a.profile, a.i, a.x, a.y, min((a.y - b.y) / (a.x - b.x)) FILTER (b.i < a.i) AS before, max((b.y - a.y) / (b.x - a.x)) FILTER (b.i > a.i) AS after FROM sample a JOIN sample b ON a.profile = b.profile AND a.i <> b.i GROUP BY ALL) "
    f"SELECT profile, CAST(row_number() OVER (PARTITION BY profile ORDER BY i) - 1 AS INT) AS vertex, {q6('x')} AS x, {q6('y')} AS y FROM up WHERE before IS NULL OR after IS NULL OR before > after + 1e-12"
)
def w5_hull_vertices(spark, sf_dir):
    """Vertices of each profile's upper hull, in columns: a sample is one if every line to the left of it is steeper than any to the right."""
    rows = profiles(spark, sf_dir, 8.0)
    hull = hulls.upper_hull(hulls.pairs(F.col("x"), F.col("y")))
    return rows.select("profile", F.posexplode(hull).alias("vertex", "p")).select("profile", "vertex", r6("p.x").alias("x"), r6("p.y").alias("y"))


@query(_SQL["j8_support_line"])
def j8_support_columns(spark, sf_dir):
    """The supporting lines from hull vertices, in columns."""
    rows = profiles(spark, sf_dir)

    def height(side):
        low, high = LANE.half(side)
        inside = F.filter(hulls.pairs(F.col("x"), F.col("y")), lambda p: (p["x"] >= low) & (p["x"] <= high))
        return r6(hulls.supporting_line(hulls.upper_hull(inside), LANE.wheel_center(side), arrays.slope_hint(rows, LANE))["height"]).alias(f"{side}_height")

    return rows.select("profile", height("left"), height("right")).filter("left_height IS NOT NULL AND right_height IS NOT NULL")


@query(_SQL["a11_residual_noise"])
def a11_noise_columns(spark, sf_dir):
    """The mirrored running mean by a running sum, in columns."""
    return profiles(spark, sf_dir).select("profile", r6(hulls.residual_noise(F.col("x"), F.col("y"), 20.0)).alias("noise"))


@query(_SQL["a7_cross_slope"].replace(sample_sql(2.0), sample_sql(0.5)))
def a7_cross_slope_kernel(spark, sf_dir):
    got = measure_profiles(_raw(spark, sf_dir, 0.5), OFF_GRID, PLAIN)
    return got.select(F.col("row_index").cast("bigint").alias("profile"), *[r6(c).alias(c) for c in ("cs_percent", "cs_degrees", "cs_intercept", "cs_r2")], "cs_points")


def _raw(spark: SparkSession, sf_dir: str, scale: float) -> DataFrame:
    return profiles(spark, sf_dir, scale).select(F.lit("0").alias("set_id"), F.col("file").alias("relative_path"), F.col("profile").cast("int").alias("row_index"), "x", "y")


def _depth_sql(side: str) -> str:
    """Depth under the bar: line over the wheel center, footprint means at breaks and vertices, first largest gap."""
    c, (zl, zh) = OFF_GRID.wheel_center(side), OFF_GRID.wheel_zone(side)
    return f"""
{side}_line AS (SELECT * FROM {side}_chord WHERE k = 1),
{side}_span AS (SELECT profile, m, h, greatest({zl}, {c} - 36.0 / sqrt(1 + m * m), ax, (SELECT min(x) FROM kept t WHERE t.profile = l.profile)) + 2.0 AS cl, least({zh}, {c} + 36.0 / sqrt(1 + m * m), bx, (SELECT max(x) FROM kept t WHERE t.profile = l.profile)) - 2.0 AS cr FROM {side}_line l),
{side}_break AS (SELECT DISTINCT profile, m, h, b FROM (SELECT profile, m, h, cl AS b FROM {side}_span WHERE cr >= cl UNION ALL SELECT profile, m, h, cr FROM {side}_span WHERE cr >= cl UNION ALL
  SELECT s.profile, m, h, k.x + d FROM {side}_span s JOIN kept k ON s.profile = k.profile, (SELECT unnest([-2.0, 2.0]) AS d) WHERE k.x + d > cl AND k.x + d < cr)),
{side}_rate AS (SELECT b.*, m - ((hi.y + (b.b + 2.0 - hi.x) * hi.g) - (lo.y + (b.b - 2.0 - lo.x) * lo.g)) / 4.0 AS d FROM {side}_break b JOIN piece lo ON lo.profile = b.profile AND b.b - 2.0 >= lo.x AND (b.b - 2.0 < lo.nx OR (lo.last AND b.b - 2.0 <= lo.nx)) JOIN piece hi ON hi.profile = b.profile AND b.b + 2.0 >= hi.x AND (b.b + 2.0 < hi.nx OR (hi.last AND b.b + 2.0 <= hi.nx))),
{side}_next AS (SELECT *, lead(b) OVER o AS nb, lead(d) OVER o AS nd FROM {side}_rate WINDOW o AS (PARTITION BY profile ORDER BY b)),
{side}_spot AS (SELECT profile, m, h, b FROM {side}_break UNION SELECT profile, m, h, b - d * (nb - b) / (nd - d) FROM {side}_next WHERE d * nd <= 0 AND abs(nd - d) > 1.4e-14),
{side}_gap AS (SELECT s.profile, s.m, s.b, ((hi.area + (s.b + 2.0 - hi.x) * (hi.y + (s.b + 2.0 - hi.x) * hi.g / 2)) - (lo.area + (s.b - 2.0 - lo.x) * (lo.y + (s.b - 2.0 - lo.x) * lo.g / 2))) / 4.0 AS mean, greatest(0.0, (h + m * (s.b - {c}) - ((hi.area + (s.b + 2.0 - hi.x) * (hi.y + (s.b + 2.0 - hi.x) * hi.g / 2)) - (lo.area + (s.b - 2.0 - lo.x) * (lo.y + (s.b - 2.0 - lo.x) * lo.g / 2))) / 4.0) / sqrt(1 + m * m)) AS gap
  FROM {side}_spot s JOIN piece lo ON lo.profile = s.profile AND s.b - 2.0 >= lo.x AND (s.b - 2.0 < lo.nx OR (lo.last AND s.b - 2.0 <= lo.nx)) JOIN piece hi ON hi.profile = s.profile AND s.b + 2.0 >= hi.x AND (s.b + 2.0 < hi.nx OR (hi.last AND s.b + 2.0 <= hi.nx))),
{side}_depth AS (SELECT profile, max(gap) AS depth FROM {side}_gap GROUP BY profile)"""


_RUT = (
    "WITH "
    + sample_sql(0.5)
    + ", kept AS (SELECT * FROM sample WHERE x > 0.0 AND x < 162.0), "
    + "seg AS (SELECT *, lead(x) OVER o AS nx, lead(y) OVER o AS ny FROM kept WINDOW o AS (PARTITION BY profile ORDER BY i)), "
    + "piece AS (SELECT profile, x, y, nx, (ny - y) / (nx - x) AS g, coalesce(sum((nx - x) * (ny + y) / 2) OVER (PARTITION BY profile ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS area, lead(nx) OVER (PARTITION BY profile ORDER BY i) IS NULL AS last FROM seg WHERE nx IS NOT NULL), "
    + _lines("left", OFF_GRID, 0.5).replace("FROM sample a JOIN sample b", "FROM kept a JOIN kept b")
    + ", "
    + _lines("right", OFF_GRID, 0.5).replace("FROM sample a JOIN sample b", "FROM kept a JOIN kept b")
    + ","
    + _depth_sql("left")
    + ","
    + _depth_sql("right")
)


@query(_RUT + f" SELECT profile, {q6('l.depth')} AS left_depth, {q6('r.depth')} AS right_depth FROM left_depth l FULL JOIN right_depth r USING (profile)")
def w7_rut_depth(spark, sf_dir):
    """Rut depth of raw profiles by the kernel; slopes stay so small that no profile has a shoulder and one round settles the tilt."""
    got = measure_profiles(_raw(spark, sf_dir, 0.5), OFF_GRID, PLAIN)
    return got.filter("left IS NOT NULL OR right IS NOT NULL").select(F.col("row_index").cast("bigint").alias("profile"), r6("left.depth").alias("left_depth"), r6("right.depth").alias("right_depth"))


@query(
    _RUT
    + ", best AS (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY round(gap, 9) DESC, b) AS k FROM right_gap) "
    + f"SELECT CAST(profile AS INT) AS profile, {q6('b')} AS rut_x, {q6('mean')} AS rut_y, {q6('m')} AS slope, CAST((SELECT count(*) FROM kept t WHERE t.profile = best.profile AND t.x BETWEEN b - 2.0 - 1e-9 AND b + 2.0 + 1e-9) AS INT) AS points FROM best WHERE k = 1 AND gap > 1e-9"
)
def w6_footprint_gap(spark, sf_dir):
    """Where the footprint lies deepest under the bar of the right wheel path, the surface's mean there, and its samples; rows with a gap."""
    got = measure_profiles(_raw(spark, sf_dir, 0.5), OFF_GRID, PLAIN).filter("right.depth > 1e-9")
    return got.select(F.col("row_index").alias("profile"), r6("right.rut_x").alias("rut_x"), r6("right.rut_y").alias("rut_y"), r6("right.bar_slope").alias("slope"), F.col("right.footprint_points").alias("points"))


def _rut_columns(spark: SparkSession, sf_dir: str, sides: tuple[str, ...]) -> DataFrame:
    """Profiles with a rut struct for each side, in columns. They cost some ms each, so they are dealt out evenly whatever a file holds."""
    rows = profiles(spark, sf_dir, 0.5).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = arrays.inside_lane(rows.withColumn("hint", arrays.slope_hint(rows, OFF_GRID)), OFF_GRID)
    return rows.select("profile", *[hulls.rut(F.col("x"), F.col("y"), F.col("hint"), OFF_GRID, side).alias(side) for side in sides])


@query(_SQL["w7_rut_depth"])
def w7_rut_columns(spark, sf_dir):
    """Rut depth of raw profiles in columns: hull, tilted bar, footprint sweep."""
    got = _rut_columns(spark, sf_dir, ("left", "right")).filter("left IS NOT NULL OR right IS NOT NULL")
    return got.select("profile", r6("left.depth").alias("left_depth"), r6("right.depth").alias("right_depth"))


@query(_SQL["w6_footprint_gap"])
def w6_gap_columns(spark, sf_dir):
    """Where the footprint lies deepest under the bar of the right wheel path, by one sweep in columns."""
    got = _rut_columns(spark, sf_dir, ("right",)).filter("right.depth > 1e-9")
    return got.select(F.col("profile").cast("int").alias("profile"), r6("right.rut_x").alias("rut_x"), r6("right.rut_y").alias("rut_y"), r6("right.bar_slope").alias("slope"), F.col("right.footprint_points").alias("points"))


_C = OFF_GRID.wheel_center("left")


@query(
    _RUT
    + ", best AS (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY round(gap, 9) DESC, b) AS k FROM left_gap), spot AS (SELECT profile, m, b - m * gap / sqrt(1 + m * m) AS mx, mean + gap / sqrt(1 + m * m) AS my, 36.0 / sqrt(1 + m * m) AS reach FROM best WHERE k = 1) "
    + f"SELECT CAST(profile AS INT) AS profile, {q6('mx')} AS measurement_point_x, {q6('my')} AS measurement_point_y, {q6(f'{_C} - reach')} AS left_reference_point_x, {q6(f'my + m * ({_C} - reach - mx)')} AS left_reference_point_y, {q6(f'{_C} + reach')} AS right_reference_point_x, {q6(f'my + m * ({_C} + reach - mx)')} AS right_reference_point_y FROM spot"
)
def p16_measurement_point(spark, sf_dir):
    """Where the depth is read off the bar, and the bar's ends."""
    from transect.config import BAR_LENGTH
    from transect.plans.golden import geometry

    got = measure_profiles(_raw(spark, sf_dir, 0.5), OFF_GRID, PLAIN).filter("left IS NOT NULL")
    at = geometry("left", OFF_GRID, BAR_LENGTH)
    return got.select(F.col("row_index").alias("profile"), *[r6(at[p, a]).alias(f"{p}_{a}") for p in ("measurement_point", "left_reference_point", "right_reference_point") for a in "xy"])


_FILE = (
    _RUT
    + ", "
    + _CROSS.format(c=81.5, t="kept")
    + ", one AS (SELECT DISTINCT profile, file FROM sample), row_ AS (SELECT file, profile, l.depth AS ld, r.depth AS rd, 100 * f.f AS cs FROM one LEFT JOIN left_depth l USING (profile) LEFT JOIN right_depth r USING (profile) LEFT JOIN (SELECT profile, f FROM fall) f USING (profile)), "
    + "agg AS (SELECT file, avg(ld) AS la, avg(rd) AS ra, avg(cs) AS cs, count(*) AS n, count(ld) AS ln, count(rd) AS rn, count(cs) AS cn FROM row_ GROUP BY file)"
)


@query(_FILE + f" SELECT file, {q6('la')} AS left_average, {q6('ra')} AS right_average, {q6('(la + ra) / 2')} AS overall_average, {q6('cs')} AS cs_percent, n AS rows_total, n AS rows_ok, ln AS left_count, rn AS right_count, cn AS cs_count, CASE WHEN (la + ra) / 2 < 0.25 THEN 0 WHEN (la + ra) / 2 < 0.5 THEN 1 WHEN (la + ra) / 2 < 1.0 THEN 2 ELSE 3 END AS severity, 'ok' AS status FROM agg")
def a2_file_aggregate(spark, sf_dir):
    """File results: side means, their mean, cross slope, counts, severity and status."""
    got = aggregate_files(measure_profiles(_raw(spark, sf_dir, 0.5), OFF_GRID, PLAIN))
    names = ("left_average", "right_average", "overall_average", "cs_percent")
    return got.select(F.col("relative_path").alias("file"), *[r6(c).alias(c) for c in names], "rows_total", "rows_ok", "left_count", "right_count", "cs_count", "severity", "status")


@query(_FILE + ", c AS (SELECT file, CASE WHEN (la + ra) / 2 < 0.25 THEN 0 WHEN (la + ra) / 2 < 0.5 THEN 1 WHEN (la + ra) / 2 < 1.0 THEN 2 ELSE 3 END AS severity FROM agg) SELECT '0' AS set_id, severity, count(*) AS files FROM c GROUP BY severity")
def a14_severity_histogram(spark, sf_dir):
    return batch.severity_histogram(aggregate_files(measure_profiles(_raw(spark, sf_dir, 0.5), OFF_GRID, PLAIN)))


#: The export's preset on scaled profiles: outliers, 19-point means without the last, shoulders by islands, then as above.
PRESET_SQL = (
    "WITH "
    + sample_sql(8.0).replace("sample AS", "raw AS", 1)
    + ", stat AS (SELECT profile, avg(y) AS m, stddev_samp(y) AS s FROM raw GROUP BY profile), ok AS (SELECT r.profile, file, row_number() OVER (PARTITION BY r.profile ORDER BY i) - 1 AS i, count(*) OVER (PARTITION BY r.profile) AS n, x, y FROM raw r JOIN stat t ON r.profile = t.profile WHERE abs(y - m) <= 3.5 * s), "
    + "mean19 AS (SELECT profile, file, i, n, avg(x) OVER o AS x, avg(y) OVER o AS y, count(*) OVER o AS c FROM ok WINDOW o AS (PARTITION BY profile ORDER BY i ROWS BETWEEN 9 PRECEDING AND 9 FOLLOWING)), "
    + "sample AS (SELECT profile, file, i - 9 AS i, x, y FROM mean19 WHERE c = 19 AND i < n - 10), "
    + "width AS (SELECT profile, median(dx) * 64 AS w FROM (SELECT profile, lead(x) OVER (PARTITION BY profile ORDER BY i) - x AS dx FROM sample) GROUP BY profile), "
    + "slopes AS (SELECT s.*, abs((lead(y) OVER o - y) / (lead(x) OVER o - x)) AS s, count(*) FILTER (x < 81.5 - 0.35 * w) OVER p AS ll, count(*) FILTER (x <= 81.5 + 0.35 * w) OVER p - 1 AS rl FROM sample s JOIN width USING (profile) WINDOW o AS (PARTITION BY profile ORDER BY i), p AS (PARTITION BY profile)), "
    + "isl AS (SELECT *, sum(CASE WHEN s > 0.055 THEN 0 ELSE 1 END) OVER (PARTITION BY profile ORDER BY i) AS k FROM slopes), "
    + "run AS (SELECT profile, k, min(i) AS a, max(i) AS b, any_value(ll) AS ll, any_value(rl) AS rl FROM isl WHERE s > 0.055 GROUP BY profile, k HAVING count(*) >= 5 AND max(s) >= 0.17), "
    + "cut AS (SELECT profile, max(b + 2) FILTER (a <= ll) AS start, min(a) FILTER (b >= rl) AS stop FROM run GROUP BY profile), "
    + "kept AS (SELECT s.* FROM sample s LEFT JOIN cut c ON s.profile = c.profile WHERE i >= coalesce(start, 0) AND i < coalesce(stop, 1000000) AND x > 0.0 AND x < 162.0), "
    + _RUT[_RUT.index("seg AS") :]
    + ", half AS (SELECT profile, count(*) FILTER (x <= 81.5) > 0 AND count(*) FILTER (x >= 81.5) > 0 AS both_ FROM kept GROUP BY profile), "
    + "row_ AS (SELECT file, profile, l.depth AS ld, r.depth AS rd, h.profile IS NOT NULL AS ok, coalesce(both_, FALSE) AS cs FROM (SELECT DISTINCT profile, file FROM raw) o LEFT JOIN left_depth l USING (profile) LEFT JOIN right_depth r USING (profile) LEFT JOIN half h USING (profile)), "
    + "agg AS (SELECT file, avg(ld) AS la, avg(rd) AS ra, count(*) FILTER (ok) AS good, count(*) FILTER (NOT ok) AS bad, count(*) FILTER (NOT cs) AS cs_bad FROM row_ GROUP BY file)"
)


@query(PRESET_SQL + f" SELECT file, {q6('la')} AS left_average, {q6('ra')} AS right_average, good AS rows_ok, bad AS rows_error, cs_bad AS cs_error_count, CASE WHEN la IS NULL OR ra IS NULL THEN 'failed' WHEN bad > 0 OR cs_bad > 0 THEN 'partial' ELSE 'ok' END AS status FROM agg")
def survey_preset(spark, sf_dir):
    """The export's own preset on scaled profiles, by file: reduction, shoulders, cross slope, rut depth, aggregate, status."""
    options = Options()
    got = aggregate_files(measure_profiles(_raw(spark, sf_dir, 8.0), OFF_GRID, options.reduction(), options))
    return got.select(F.col("relative_path").alias("file"), r6("left_average").alias("left_average"), r6("right_average").alias("right_average"), "rows_ok", "rows_error", "cs_error_count", "status")


@query(
    "WITH r AS (SELECT CAST(l_suppkey % 50 AS VARCHAR) AS file, l_orderkey, l_linenumber, l_orderkey * 8 + l_linenumber AS row_index, l_orderkey % 6 = 0 AS e, l_orderkey % 9 = 0 AS c, l_linenumber % 5 = 0 AS noisy FROM lineitem), "
    "m AS (SELECT file, row_index, 0 AS o, 'row ' || row_index || ' cross slope: C' AS m FROM r WHERE c UNION ALL SELECT file, row_index, 1, 'row ' || row_index || ': E' FROM r WHERE e) "
    "SELECT file, count(*) AS rows_total, count(*) FILTER (NOT e) AS rows_ok, count(*) FILTER (e) AS rows_error, count(*) FILTER (noisy) AS rows_noisy, count(*) FILTER (c) AS cs_error_count, (SELECT array_to_string(list(m ORDER BY row_index, o)[1:10], ';') FROM m WHERE m.file = r.file) AS errors, 'failed' AS status FROM r GROUP BY file"
)
def a4_row_counters(spark, sf_dir):
    """Counters, first ten messages and status of files whose rows failed in various ways."""
    from transect import schemas

    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    row = table(spark, sf_dir, "lineitem").select(
        F.lit("0").alias("set_id"), (F.col("l_suppkey") % 50).cast("string").alias("relative_path"), (k * 8 + n).cast("int").alias("row_index"), (n % 5 == 0).alias("is_noisy"), F.when(k % 9 == 0, "C").alias("cs_error"),
        F.when(k % 6 == 0, "error").otherwise("ok").alias("state"), F.when(k % 6 == 0, "E").alias("row_error"), F.lit(None).cast("double").alias("cs_percent"), F.lit(None).cast("double").alias("cs_degrees"),
        F.lit(None).cast(schemas.SIDE).alias("left"), F.lit(None).cast(schemas.SIDE).alias("right"), F.lit(None).cast("string").alias("file_error"),
    )
    got = aggregate_files(row)
    return got.select(F.col("relative_path").alias("file"), "rows_total", "rows_ok", "rows_error", "rows_noisy", "cs_error_count", F.array_join("error_samples", ";").alias("errors"), "status")


@query(f"SELECT o_custkey, {q6('avg(CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END)')} AS mean FROM orders GROUP BY o_custkey")
def a1_finite_mean(spark, sf_dir):
    odd = F.when(F.col("o_orderkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(r6(F.avg(scalars.finite(odd))).alias("mean"))


_PIECES = f"WITH {sample_sql(8.0)}, piece AS (SELECT profile, i, x, y, lead(x) OVER o AS nx, lead(y) OVER o AS ny FROM sample WINDOW o AS (PARTITION BY profile ORDER BY i)), probe AS (SELECT vec_id AS profile, 5.0 + vec_id % 150 AS pos FROM embeddings)"


@query(_PIECES + f" SELECT profile, {q6('y + (pos - x) * (ny - y) / (nx - x)')} AS height FROM probe JOIN piece USING (profile) WHERE pos >= x AND pos < nx")
def p9_surface_at(spark, sf_dir):
    return profiles(spark, sf_dir, 8.0).select("profile", r6(arrays.surface_at(5.0 + F.col("profile") % 150)).alias("height"))


@query(_PIECES + f" SELECT profile, {q6('sum((least(nx, pos) - x) * (y + y + (least(nx, pos) - x) * (ny - y) / (nx - x)) / 2)')} AS area FROM probe JOIN piece USING (profile) WHERE x < pos AND nx IS NOT NULL GROUP BY profile")
def p10_area_until(spark, sf_dir):
    return profiles(spark, sf_dir, 8.0).select("profile", r6(arrays.area_until(5.0 + F.col("profile") % 150)).alias("area"))


_LE = "unhex(printf('%02x%02x000000000000', ({n}) % 256, ({n}) // 256))"


def _probe_part(at: str) -> str:
    return f"|| {_LE.format(n=at)} || {_LE.format(n='least(size, 4096)')} || encode(substr(body, CAST({at} AS BIGINT) + 1, 4096))"


@query(
    "WITH f AS (SELECT s_suppkey, repeat('file ' || s_suppkey || ';', CAST(1 + s_suppkey % 3 * 900 AS INT)) AS body FROM supplier), s AS (SELECT *, length(body) AS size FROM f) SELECT s_suppkey, "
    f"CASE WHEN size <= 4096 THEN sha256(encode('probe:' || size || ':') {_probe_part('0')}) ELSE sha256(encode('probe:' || size || ':') {_probe_part('0')} {_probe_part('(size - 4096) // 2')} {_probe_part('size - 4096')}) END AS digest FROM s"
)
def a18_file_probe(spark, sf_dir):
    """Hash of the first, middle and last 4 KiB of contents of 7 to 20,000 bytes, with their places."""
    import pandas as pd

    def probed(batches):
        for b in batches:
            yield pd.DataFrame({"s_suppkey": b["s_suppkey"], "digest": [probe(lambda at, n, x=x: x[at : at + n], len(x)) for x in map(bytes, b["body"])]})

    body = F.expr("repeat(concat('file ', s_suppkey, ';'), CAST(1 + s_suppkey % 3 * 900 AS INT))").cast("binary")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), body.alias("body")).mapInPandas(probed, "s_suppkey bigint, digest string")


@query(
    "WITH e AS (SELECT o_custkey AS k, o_orderkey % 2 AS odd, max(o_orderkey) AS o FROM orders GROUP BY 1, 2), latest AS (SELECT k, arg_min(o, odd) AS o FROM e GROUP BY k), "
    "done AS (SELECT k FROM latest JOIN orders ON o_orderkey = o WHERE o_orderstatus <> 'F') SELECT c_custkey AS pending FROM customer WHERE c_custkey NOT IN (SELECT k FROM done)"
)
def j4_pending_files(spark, sf_dir):
    """Index rows without a reusable entry in a checkpoint of two chunks, of which the second is newer."""
    from transect import schemas

    orders = table(spark, sf_dir, "orders")
    newest = orders.groupBy("o_custkey", (F.col("o_orderkey") % 2).alias("odd")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("s"))
    names = [(f.split(" ")[0], f.split(" ")[1]) for f in schemas.FILE_RESULT.split(", ")]
    known = {"relative_path": F.col("o_custkey").cast("string"), "status": F.when(F.col("s") == "F", "failed").otherwise("ok"), "start_frame": F.lit(1.0), "end_frame": F.lit(2.0)}
    done = Checkpoint(spark, new_folder(spark, "entries"), "q")
    for odd in (1, 0):
        rows = newest.filter(F.col("odd") == odd).select(*[known.get(n, F.lit(None)).cast(t).alias(n) for n, t in names], F.lit(9).cast("bigint").alias("size"), F.lit(9).cast("bigint").alias("changed"), F.lit("p").alias("probe"))
        done.append(rows, 10 - odd)
    index = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pending"), F.col("c_custkey").cast("string").alias("relative_path"))
    return index.join(done.reusable().select("relative_path"), "relative_path", "left_anti").select("pending")


@query(f"WITH {_INDEX} SELECT CAST(row_number() OVER (ORDER BY start_frame, lower(relative_path), relative_path) - 1 AS INT) AS pos, relative_path, start_frame, CASE WHEN nxt > start_frame THEN nxt ELSE start_frame + usual END AS end_frame FROM stepped JOIN usual USING (set_id) WHERE set_id = '7'")
def k5_index_json(spark, sf_dir):
    """One set's index, written as JSON and read back in stored order (K5, S3)."""
    at = f"{new_folder(spark, 'index')}/i.json"
    survey.write_index(_index(spark, sf_dir).filter("set_id = '7'"), at)
    return survey.read_index(spark, at, "7").drop("set_id")


_EXPORTED = """track AS (SELECT CAST(e AS DOUBLE) AS f FROM (SELECT DISTINCT event_id * 5 AS e FROM events)),
r AS (SELECT o_orderkey, CAST(o_orderkey % 4 AS INT) AS severity, o_orderkey * 2.0 AS f, 'd/' || o_orderkey || '.3dc' AS path FROM orders),
x AS (SELECT *, f BETWEEN (SELECT min(f) FROM track) AND (SELECT max(f) FROM track) AS inside FROM r)"""
_EXPORTED_ROWS = f"SELECT path AS relative_path, f AS starting_frame_number, CASE WHEN inside THEN {q6('f / 10')} END AS latitude, CASE WHEN inside THEN {q6('-f / 7')} END AS longitude, CASE WHEN inside THEN {q6('f / 3')} END AS heading, severity, CASE WHEN severity >= 2 THEN 'previews/' || CASE severity WHEN 2 THEN 'moderate' ELSE 'high' END || '_' || CAST(f AS BIGINT) || '_' || o_orderkey || '.png' END AS preview_png FROM x"


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows of a result for each order along a straight track. A frame that is there twice has the same values, so interpolation takes it once."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.lit("7").alias("set_id"), F.concat(F.lit("d/"), k, F.lit(".3dc")).alias("relative_path"), F.concat(k, F.lit(".3dc")).alias("file_name"), (k * 2.0).alias("start_frame"), (k % 4).cast("int").alias("severity"),
        *[(k / 8).cast("double").alias(c) for c in ("left_average", "right_average", "overall_average", "cs_percent", "cs_degrees")], *[F.lit(1).cast("bigint").alias(c) for c in ("cs_count", "cs_error_count")],
    )
    track = table(spark, sf_dir, "events").select((F.col("event_id") * 5).cast("double").alias("frame")).select(F.lit("7").alias("set_id"), "frame", (F.col("frame") / 10).alias("lat"), (-F.col("frame") / 7).alias("lon"), (F.col("frame") / 3).alias("heading"))
    return export_rows(rows, track.select("set_id", "frame", "lat", "lon"), track.select("set_id", "frame", "heading"))


_SHOWN = ("relative_path", "starting_frame_number", "latitude", "longitude", "heading", "severity", "preview_png")


@query(f"WITH {_EXPORTED} {_EXPORTED_ROWS}")
def f10_export_rows(spark, sf_dir):
    """Positions at the start frames and names of the previews of severe files."""
    return _exported(spark, sf_dir).select(*[r6(c).alias(c) if c in ("latitude", "longitude", "heading") else c for c in _SHOWN])


@query(f"WITH {_EXPORTED} SELECT *, row_number() OVER (ORDER BY starting_frame_number) - 1 AS line FROM ({_EXPORTED_ROWS})")
def k1_export_csv(spark, sf_dir):
    """Export rows written as CSV in index order and read back (K1, O3)."""
    from transect import schemas

    at = f"{new_folder(spark, 'csv')}/r.csv"
    write_csv(_exported(spark, sf_dir).checkpoint(), at)
    kinds = {"severity": "int", **dict.fromkeys(("set", "file_name", "relative_path", "preview_png"), "string")}
    rows = spark.read.option("header", True).schema(", ".join(f"`{c}` {kinds.get(c, 'double')}" for c in schemas.EXPORT_COLUMNS)).csv(at)
    numbered = running_number(rows.select(*_SHOWN, F.lit(1).alias("one"), F.monotonically_increasing_id().alias("place")), "one", ["place"], "line")
    return numbered.withColumn("line", F.col("line").cast("bigint") - 1).select("line", *[r6(c).alias(c) if c in ("latitude", "longitude", "heading") else c for c in _SHOWN])


@query(f"WITH {_EXPORTED} SELECT CAST(row_number() OVER (ORDER BY starting_frame_number) - 1 AS INT) AS pos, *, longitude AS lon, latitude AS lat FROM ({_EXPORTED_ROWS})")
def k2_export_geojson(spark, sf_dir):
    """Export rows written as GeoJSON and read back as the map does (K2, S14); no point where there is no position."""
    at = f"{new_folder(spark, 'geojson')}/r.geojson"
    write_geojson(_exported(spark, sf_dir).checkpoint(), at, "r")
    return maps.features(spark, at).select("pos", *[r6(c).alias(c) if c in ("latitude", "longitude", "heading") else c for c in _SHOWN], r6("lon").alias("lon"), r6("lat").alias("lat"))


@query("SELECT 'price' AS value, TRUE AS differs, count(*) FILTER (o_orderkey % 50 <> 0 AND o_orderkey % 77 <> 0) AS passed, count(*) AS n, count(*) FILTER (o_orderkey % 77 = 0) AS alone FROM orders")
def j7_golden_join(spark, sf_dir):
    """A full join of expected and actual rows; those on one side only fail."""
    from transect.plans.compare import matched

    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    changed = rows.filter("o_orderkey % 77 <> 0").withColumn("price", F.col("price") * (1 + F.when(F.col("o_orderkey") % 50 == 0, 0.001).otherwise(0.0)))
    got = matched(rows, changed, ["o_orderkey"], ["price"], 1e-9)
    return got.select("value", (F.col("max_error") > 0).alias("differs"), "passed", "n", "alone")


# Joins and roll-ups


_NAV = "nav AS (SELECT user_id, epoch_us(ts) / 1e6 AS f, value FROM events WHERE event_type = 'view'), probe AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS f FROM events WHERE event_type = 'purchase')"


@query(
    f"WITH {_NAV}, seg AS (SELECT user_id, f AS f0, value AS v0, lead(f) OVER o AS f1, lead(value) OVER o AS v1 FROM nav WINDOW o AS (PARTITION BY user_id ORDER BY f)) "
    f"SELECT p.event_id, {q6('CASE WHEN p.f = f0 THEN v0 ELSE v0 + (p.f - f0) / (f1 - f0) * (v1 - v0) END')} AS value FROM probe p LEFT JOIN seg s ON p.user_id = s.user_id AND p.f >= f0 AND (p.f < f1 OR (f1 IS NULL AND p.f = f0))"
)
def j2_nav_interpolate(spark, sf_dir):
    """Values of `view` events of a user interpolated at the times of their `purchase` events."""
    # Seconds since 1970 are large, so neighbours are told apart by microseconds and not by the relative tolerance of frames.
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id"), "event_type", "value", seconds.alias("frame"))
    track = events.filter("event_type = 'view'").select("user_id", (F.col("frame") - BASE).alias("frame"), "value")
    probes = events.filter("event_type = 'purchase'").select("event_id", "user_id", (F.col("frame") - BASE).alias("at"))
    return survey.interpolated(probes, "at", track, ["value"], "user_id", "frame").select("event_id", r6("value").alias("value"))


@query(
    "WITH nav AS (SELECT user_id % 4 AS k, CAST(epoch_us(ts) // 300000000 AS DOUBLE) - 5680224 AS f, arg_min(event_id, event_id) AS a, arg_max(event_id, event_id) AS b FROM events WHERE event_type = 'view' GROUP BY 1, 2), "
    "seg AS (SELECT n.k, f, x.value AS v0, y.value AS w0, x.event_id % 1000 AS h0, y.event_id % 1000 AS g0 FROM nav n JOIN events x ON x.event_id = n.a JOIN events y ON y.event_id = n.b), "
    "line AS (SELECT *, lead(f) OVER o AS f1, lead(v0) OVER o AS v1, lead(h0) OVER o AS h1 FROM seg WINDOW o AS (PARTITION BY k ORDER BY f)), "
    "probe AS (SELECT event_id, user_id % 4 AS k, CAST(epoch_us(ts) // 100000000 AS DOUBLE) / 3 - 5680224 AS f FROM events WHERE event_type = 'purchase') "
    f"SELECT p.event_id, {q6('CASE WHEN p.f = s.f THEN v0 ELSE w0 + (p.f - s.f) / (f1 - s.f) * (v1 - w0) END')} AS value, {q6('CASE WHEN p.f = s.f THEN h0 ELSE g0 + (p.f - s.f) / (f1 - s.f) * (h1 - g0) END')} AS heading "
    "FROM probe p LEFT JOIN line s ON p.k = s.k AND p.f >= s.f AND (p.f < f1 OR (f1 IS NULL AND p.f = s.f))"
)
def j3_nav_repeated_frames(spark, sf_dir):
    """Two columns of a track with many rows for one frame, at and between its frames, in short spans: the first row ends a line, the last one begins it."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 4).alias("k"), "event_type", "value", micros.alias("us"))
    track = events.filter("event_type = 'view'").select("k", (F.expr("us div 300000000").cast("double") - 5680224).alias("frame"), "value", (F.col("event_id") % 1000).cast("double").alias("heading"), F.col("event_id").alias("line"))
    probes = events.filter("event_type = 'purchase'").select("event_id", "k", (F.expr("us div 100000000").cast("double") / 3 - 5680224).alias("at"))
    got = survey.interpolated(probes, "at", track, ["value", "heading"], "k", span=500.0)
    return got.select("event_id", r6("value").alias("value"), r6("heading").alias("heading"))


#: Seconds of the events' first day, so that their frames are small numbers.
BASE = 1704067200.0


@query("SELECT CAST(n_nationkey AS VARCHAR) AS set_id FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 3 = 0)")
def j6_missing_sets(spark, sf_dir):
    wanted = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("set_id"))
    there = table(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 0").select(F.col("s_nationkey").cast("string").alias("set_id"))
    return batch.missing_sets(wanted, there)


@query("SELECT CAST(c_nationkey AS VARCHAR) AS set_id FROM customer WHERE c_custkey % 5 = 0 GROUP BY 1 HAVING count(*) > 1")
def o6_repeated_sets(spark, sf_dir):
    return batch.repeated_sets(table(spark, sf_dir, "customer").filter("c_custkey % 5 = 0").select(F.col("c_nationkey").cast("string").alias("set_id")))


_STATUS = "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'failed' WHEN o_orderstatus = 'P' THEN 'partial' ELSE 'ok' END"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 2 == 0), "failed").when(F.col("o_orderstatus") == "P", "partial").otherwise("ok")
    return table(spark, sf_dir, "orders").select((F.col("o_custkey") % 500).cast("string").alias("set_id"), F.col("o_orderkey").alias("file"), status.alias("status"))


_ROLL = f"f AS (SELECT CAST(o_custkey % 500 AS VARCHAR) AS set_id, {_STATUS} AS status FROM orders), s AS (SELECT set_id, count(*) AS files, count(*) FILTER (status = 'ok') AS files_ok, count(*) FILTER (status = 'partial') AS files_partial, count(*) FILTER (status = 'failed') AS files_failed FROM f GROUP BY set_id)"


@query(f"WITH {_ROLL} SELECT *, CASE WHEN files_ok = files THEN 'ok' ELSE 'partial' END AS status FROM s")
def a15_set_rollup(spark, sf_dir):
    return batch.set_rollup(_files(spark, sf_dir))


@query(f"WITH {_ROLL} SELECT count(*) AS sets_total, count(*) FILTER (files_ok = files) AS sets_ok, count(*) FILTER (files_ok <> files) AS sets_failed, CAST(sum(files) AS BIGINT) AS records_exported, CAST(sum(files_partial) AS BIGINT) AS files_partial, CAST(sum(files_failed) AS BIGINT) AS files_failed FROM s")
def a15_batch_rollup(spark, sf_dir):
    return batch.batch_rollup(batch.set_rollup(_files(spark, sf_dir)))


@query("SELECT CAST(k AS VARCHAR) AS set_id, k AS place FROM (SELECT DISTINCT c_custkey % 120 AS k FROM customer)")
def o4_set_order(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 120).cast("string").alias("set_id")).distinct()
    return batch.in_set_order(rows).select("set_id", F.col("set_id").cast("bigint").alias("place"))


@query("WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 20 THEN 0 WHEN l_quantity < 40 THEN 1 WHEN l_quantity < 48 THEN 2 ELSE 3 END AS severity FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY severity ORDER BY l_orderkey, l_linenumber) AS k FROM r) SELECT l_orderkey, l_linenumber, severity FROM n WHERE severity >= 2 OR (severity = 1 AND k % 5 = 1) OR (severity = 0 AND k % 10 = 1)")
def w10_display_sample(spark, sf_dir):
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(q < 20, 0).when(q < 40, 1).when(q < 48, 2).otherwise(3).alias("severity"))
    return maps.display_sample(rows, ["l_orderkey", "l_linenumber"])


@query("SELECT count(*) AS mapped, min(c_acctbal) AS west, min(c_nationkey) * 1.0 AS south, max(c_acctbal) AS east, max(c_nationkey) * 1.0 AS north FROM customer WHERE c_custkey % 4 <> 0")
def a16_bounds(spark, sf_dir):
    lon = F.when(F.col("c_custkey") % 8 == 0, F.lit(float("nan"))).when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal"))
    return maps.bounds(table(spark, sf_dir, "customer").select(lon.alias("lon"), F.col("c_nationkey").cast("double").alias("lat")))


@query(f"SELECT l_suppkey, {q6('max(abs(l_discount - l_tax))')} AS max_error, {q6('sqrt(avg(pow(l_discount - l_tax, 2)))')} AS rmse, count(*) FILTER (abs(l_discount - l_tax) <= 0.03) AS passed, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def a17_compare(spark, sf_dir):
    from transect.plans.compare import error_summary

    return error_summary(table(spark, sf_dir, "lineitem"), F.col("l_discount"), F.col("l_tax"), 0.03, ["l_suppkey"]).select("l_suppkey", r6("max_error").alias("max_error"), r6("rmse").alias("rmse"), "passed", "n")
