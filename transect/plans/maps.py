"""A combined map of all sets: one GeoJSON, a sampled one for display, bounds, and a page that shows it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transect.plans.files import ensure_shared_folder, write_text
from transect.plans.ordered import write_ordered
from transect.plans.ranking import running_number

FEATURE = (
    "struct<type:string,geometry:struct<type:string,coordinates:array<double>>,properties:struct<"
    "`set`:string,file_name:string,relative_path:string,starting_frame_number:double,latitude:double,longitude:double,heading:double,averaged_left_rut:double,averaged_right_rut:double,averaged_rut:double,"
    "cross_slope_average_percent:double,cross_slope_average_angle_degrees:double,cross_slope_count:bigint,cross_slope_error_count:bigint,severity:int,preview_png:string>>"
)
#: First line of our own exports, which have each feature on a line of its own.
OWN_HEAD = r'^\{"type":"FeatureCollection","name":.*,"features":\[$'
#: Of the points of a class each n-th is shown; other classes are left out.
SHOWN = {3: 1, 2: 1, 1: 5, 0: 10}


def features(spark: SparkSession, pattern: str) -> DataFrame:
    """(pos, properties..., lon, lat) of the features of GeoJSON exports; pos is the place in its file.

    Files as write_geojson() makes them are read by lines, so a large one is many tasks; a line that is no feature ends the
    job. Other forms are read whole, a task for each file.
    """
    ensure_shared_folder(spark)
    at = F.col("_metadata.file_path")
    lines = spark.read.text(pattern).select(at.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    one = ~(F.startswith("value", F.lit('{"type":"FeatureCollection"')) | F.startswith("value", F.lit("]}")) | (F.col("value") == ""))
    # Lines of a block have numbers in a row: a feature's place is its distance from its block's first one, and the features of the blocks before.
    blocks = lines.groupBy("file", "block").agg(F.count(F.when(one, 1)).alias("n"), F.min(F.when(one, F.col("id"))).alias("first"), F.max((F.col("block") == 0) & F.rlike("value", F.lit(OWN_HEAD))).alias("own")).checkpoint()
    kinds = {r.file: r.own for r in blocks.groupBy("file").agg(F.max("own").alias("own")).collect()}
    other = [f for f, own in kinds.items() if not own]
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = blocks.select("file", "block", (before - F.col("first")).alias("shift"))
    mine = one & ~F.col("file").isin(other) if other else one
    # Filters on what is parsed may run before the one below, so no other line is ever parsed.
    parsed = F.when(mine, F.from_json(F.rtrim("value", F.lit(",")), FEATURE, {"mode": "FAILFAST"}))
    rows = lines.filter(mine).join(F.broadcast(places), ["file", "block"]).select((F.col("id") + F.col("shift")).cast("int").alias("pos"), parsed.alias("f"))
    if other:
        whole = spark.read.schema(f"type string, features array<{FEATURE}>").option("multiLine", True).json(pattern).filter(at.isin(other))
        rows = rows.unionByName(whole.select(F.posexplode("features").alias("pos", "f")))
    return rows.select("pos", "f.properties.*", F.get("f.geometry.coordinates", F.lit(0)).alias("lon"), F.get("f.geometry.coordinates", F.lit(1)).alias("lat"))


def display_sample(rows: DataFrame, order: list[str], by: str = "severity") -> DataFrame:
    """Rows to show: per class, in the given order, the first and then each n-th (SHOWN).

    The running number of a class is counted over ranges of the order: rows are sorted into ranges by the distributed
    sort, each range counts its classes, and the counts before it are added, so that no class is a task of its own.
    """
    every = F.coalesce(*[F.when(F.col(by) == k, n) for k, n in SHOWN.items()])
    kept = rows.withColumn("__every", every).filter("__every IS NOT NULL")
    return running_number(kept, by, order, "__n").filter("__n % __every = 1 OR __every = 1").drop("__every", "__n")


def bounds(rows: DataFrame) -> DataFrame:
    """(mapped, west, south, east, north) over rows that have a position."""
    return rows.filter("lon IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lon) AND NOT isnan(lat)").agg(F.count("*").alias("mapped"), F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"))


def relative_preview(path, folder: str):
    """A preview's path below a folder; the path as it is if it lies elsewhere."""
    base = folder.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(base)), F.substring(path, len(base) + 1, 1 << 30)).otherwise(path)


_PAGE = """<!doctype html><meta charset="utf-8"><title>{title}</title><style>body{{margin:0;font:14px sans-serif}}svg{{width:100vw;height:90vh}}</style>
<p>{title}: {shown} of {mapped} points</p><svg viewBox="{west} {top} {width} {height}" preserveAspectRatio="xMidYMid"></svg>
<script>const c=["#2b83ba","#a6d96a","#fdae61","#d7191c"],s=document.querySelector("svg");fetch("{data}").then(r=>r.json()).then(g=>{{for(const f of g.features){{const [x,y]=f.geometry.coordinates,e=document.createElementNS("http://www.w3.org/2000/svg","circle");e.setAttribute("cx",x);e.setAttribute("cy",-y);e.setAttribute("r",{radius});e.setAttribute("fill",c[f.properties.severity]||"#999");s.append(e)}}}})</script>
"""


def build_map(spark: SparkSession, root: str, out: str) -> dict:
    """Write combined.geojson, display.geojson, map.html and manifest.json from root/set_*/set_*_rut_results.geojson; the manifest. ValueError without a valid point."""
    rows = features(spark, f"{root.rstrip('/')}/set_*/set_*_rut_results.geojson").withColumn("number", F.col("set").cast("decimal(38,0)"))
    placed = rows.filter("lon IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lon) AND NOT isnan(lat)")
    b = bounds(placed).first()
    if not b.mapped:
        raise ValueError("no valid point was found")
    order = ["number", "set", "pos"]
    shown = display_sample(placed, order)

    def point(row: dict) -> bytes:
        p = {n: v for n, v in row.items() if n not in ("pos", "number", "lon", "lat")}
        return json.dumps({"type": "Feature", "geometry": {"type": "Point", "coordinates": [row["lon"], row["lat"]]}, "properties": p}, allow_nan=False).encode()

    for name, points in (("combined", placed), ("display", shown)):
        write_ordered(points, order, f"{out}/{name}.geojson", point, b'{"type":"FeatureCollection","features":[', b",", b"]}\n")
    classes = {str(r.severity): r.n for r in shown.groupBy("severity").agg(F.count("*").alias("n")).collect()}
    width, height = max(b.east - b.west, 1e-6), max(b.north - b.south, 1e-6)
    page = _PAGE.format(title="Rut depth", shown=sum(classes.values()), mapped=b.mapped, west=b.west, top=-b.north, width=width, height=height, radius=max(width, height) / 400, data="display.geojson")
    write_text(f"{out}/map.html", page)
    manifest = {"schema_version": 1, "mapped": b.mapped, "unmapped": rows.count() - b.mapped, "bounds": [b.west, b.south, b.east, b.north], "display_counts": classes}
    write_text(f"{out}/manifest.json", json.dumps(manifest, indent=2))
    return manifest
