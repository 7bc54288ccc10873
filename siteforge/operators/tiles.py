"""Geometry of parcels, tiles and map windows. Rings are closed, array<struct<x, y>>, in metres unless said."""
from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, StructField, StructType

from siteforge.functions import geo
from siteforge.operators import cluster, joins

# Tile side and stride, caps and the half side of a capped parcel's tile, in metres; a window's width in km and its rows.
TILE_M, STRIDE_M, MAX_AREA_M2, MAX_TILES, HALF_M = 500.0, 450.0, 2_000_000.0, 150, 250.0
MAX_VIEW_KM, MAX_VIEW_ROWS = 14.0, 15_000


def bounds(ring: Column) -> tuple[Column, Column, Column, Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


@F.pandas_udf(StructType([StructField(c, DoubleType()) for c in ("x", "y", "r")]))
def _pole(rings: pd.Series) -> pd.DataFrame:
    """The point of a ring's area that is farthest from its edges, to a hundredth of the area's root (half a metre at least): the
    best of a grid, refined cell by cell while a cell could hold a better one."""

    def distance(x, y, ring):
        inside, best = False, math.inf
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                inside = not inside
            dx, dy = bx - ax, by - ay
            t = max(0.0, min(1.0, ((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
            best = min(best, math.hypot(x - ax - t * dx, y - ay - t * dy))
        return best if inside else -best

    def one(points):
        ring = [(p["x"], p["y"]) for p in points]
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        w, h = max(xs) - min(xs), max(ys) - min(ys)
        area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))) / 2
        side, tol = min(w, h) / 2, max(0.5, math.sqrt(area) / 100)
        if side <= 0:
            return (xs[0], ys[0], 0.0)
        cells = [(min(xs) + (i + 0.5) * 2 * side, min(ys) + (j + 0.5) * 2 * side, side) for i in range(math.ceil(w / (2 * side))) for j in range(math.ceil(h / (2 * side)))]
        best = (-math.inf, 0.0, 0.0)
        while cells:
            scored = [(distance(x, y, ring), x, y, s) for x, y, s in cells]
            best = max([best, *[(d, x, y) for d, x, y, _ in scored]])
            cells = [(x + i * s / 2, y + j * s / 2, s / 2) for d, x, y, s in scored if d + s * math.sqrt(2) > best[0] + tol for i in (-1, 1) for j in (-1, 1)]
        return (best[1], best[2], best[0])

    return pd.DataFrame([one(r) for r in rings], columns=["x", "y", "r"])


def interior_points(df: DataFrame, ring: str = "ring") -> DataFrame:
    """df with px, py and point_method: the centroid where it is inside, else the pole of inaccessibility (only then Python runs).

    Rings of four corners are worked out in plain arithmetic, which Spark compiles; a lambda runs for all others.
    """
    r = F.col(ring)
    four, corners = geo.four_corners(r)
    d = df.withColumn("c_", F.when(four, geo.corners_centroid(corners)).otherwise(geo.centroid(r)))
    d = d.select(*df.columns, F.inline(F.array("c_")).alias("x_", "y_"))  # generators: filters don't copy the expressions below them
    d = d.withColumn("i_", F.when(four, geo.in_corners(corners, F.col("x_"), F.col("y_"))).otherwise(geo.in_ring(r, F.col("x_"), F.col("y_"))))
    d = d.select(*df.columns, "x_", "y_", F.explode(F.array("i_")).alias("in_"))
    inside = d.where("in_").select(*df.columns, F.col("x_").alias("px"), F.col("y_").alias("py"), F.lit("centroid").alias("point_method"))
    rest = d.where("not in_").withColumn("p_", _pole(ring))
    return inside.unionByName(rest.select(*df.columns, F.col("p_.x").alias("px"), F.col("p_.y").alias("py"), F.lit("polylabel").alias("point_method")))


def largest_part(df: DataFrame, key: str, ring: str = "ring") -> DataFrame:
    """(key, ring) with the part of largest area of each multipart shape."""
    return df.groupBy(key).agg(F.max_by(ring, geo.ring_area(F.col(ring))).alias(ring))


def site_points(sites: DataFrame, objects: DataFrame, least: float = 0.4) -> DataFrame:
    """(site, x, y, coord_method, n_objects) of sites (site, ring, seed): the mean of the strong objects (site, x, y, conf) inside any of the
    site's rings, else the interior point of its seed ring."""
    strong = objects.where(F.col("conf") >= least).select("site", F.col("x").alias("ox"), F.col("y").alias("oy")).distinct()  # a place is tested once
    hit = sites.join(strong, "site").where(geo.in_ring(F.col("ring"), F.col("ox"), F.col("oy"))).select("site", "ox", "oy").distinct()
    mean = hit.groupBy("site").agg(F.avg("ox").alias("mx"), F.avg("oy").alias("my"), F.count(F.lit(1)).alias("n"))
    seed = interior_points(sites.where("seed").select("site", "ring"))
    d = seed.join(mean, "site", "left")
    return d.select("site", F.coalesce("mx", "px").alias("x"), F.coalesce("my", "py").alias("y"), F.when(F.col("n").isNotNull(), "objects").otherwise(F.col("point_method")).alias("coord_method"), F.coalesce("n", F.lit(0)).alias("n_objects"))


def in_parcel(objects: DataFrame, parcels: DataFrame) -> DataFrame:
    """objects (parcel, x, y) with in_parcel: whether they lie in their own parcel's ring; false without one."""
    d = objects.join(parcels.select("parcel", "ring"), "parcel", "left")
    return d.withColumn("in_parcel", F.coalesce(geo.in_ring(F.col("ring"), F.col("x"), F.col("y")), F.lit(False))).drop("ring")


def tile_grid(df: DataFrame, ring: str = "ring") -> DataFrame:
    """df with tx, ty (corner) for each tile of the grid over the ring's box that the ring touches; one centred tile if a side is under a
    tile, and one on the centroid if none is touched."""
    x0, y0, x1, y1 = bounds(F.col(ring))
    d = df.withColumns({"x0_": x0, "y0_": y0, "x1_": x1, "y1_": y1})
    n = lambda a, b: F.greatest(F.lit(1), F.ceil((F.col(b) - F.col(a)) / STRIDE_M)).cast("int")
    steps = lambda a, b: F.transform(F.sequence(F.lit(0), n(a, b) - 1), lambda i: F.col(a) + i * STRIDE_M)
    all_ = F.flatten(F.transform(steps("x0_", "x1_"), lambda x: F.transform(steps("y0_", "y1_"), lambda y: F.struct(x.alias("tx"), y.alias("ty")))))
    touched = F.filter(all_, lambda t: geo.ring_meets_box(F.col(ring), t["tx"], t["ty"], t["tx"] + TILE_M, t["ty"] + TILE_M))
    at = lambda x, y: F.array(F.struct((x - TILE_M / 2).alias("tx"), (y - TILE_M / 2).alias("ty")))
    centre = geo.centroid(F.col(ring))
    small = (F.col("x1_") - F.col("x0_") < TILE_M) | (F.col("y1_") - F.col("y0_") < TILE_M)
    d = d.withColumn("c_", centre).withColumn("tiles", F.when(small, at((F.col("x0_") + F.col("x1_")) / 2, (F.col("y0_") + F.col("y1_")) / 2)).otherwise(touched))
    d = d.withColumn("tiles", F.when(F.size("tiles") > 0, F.col("tiles")).otherwise(at(F.col("c_.x"), F.col("c_.y"))))
    return d.select(*df.columns, F.explode("tiles").alias("t")).select(*df.columns, "t.tx", "t.ty")


def one_or_nine(df: DataFrame, ring: str = "ring") -> DataFrame:
    """df with row, col, tx, ty: the tile centred on the centroid (row 2, col 2), and the eight around it if the ring overruns it; row 1 is north."""
    x0, y0, x1, y1 = bounds(F.col(ring))
    d = df.withColumns({"c_": geo.centroid(F.col(ring)), "x0_": x0, "y0_": y0, "x1_": x1, "y1_": y1})
    h = TILE_M / 2
    fits = (F.col("x0_") >= F.col("c_.x") - h) & (F.col("x1_") <= F.col("c_.x") + h) & (F.col("y0_") >= F.col("c_.y") - h) & (F.col("y1_") <= F.col("c_.y") + h)
    off = F.array(*[F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    middle = F.array(F.struct(F.lit(0).alias("dr"), F.lit(0).alias("dc")))
    d = d.withColumn("o_", F.explode(F.when(fits, middle).otherwise(off)))
    return d.select(*df.columns, (F.col("o_.dr") + 2).alias("row"), (F.col("o_.dc") + 2).alias("col"), (F.col("c_.x") + F.col("o_.dc") * TILE_M - h).alias("tx"), (F.col("c_.y") - F.col("o_.dr") * TILE_M - h).alias("ty"))


def capped(df: DataFrame, n_tiles: Column, fallback_x: Column, fallback_y: Column, ring: str = "ring") -> DataFrame:
    """df with cap_reason (area, tile_count or null) and footprint: the ring itself, or one square on the fallback point where it is capped
    (a point on the ring's surface where there is none)."""
    area = geo.ring_area(F.col(ring))
    reason = F.when(area > MAX_AREA_M2, "area").when(n_tiles > MAX_TILES, "tile_count")
    own = geo.surface_point(F.col(ring))
    d = df.withColumn("cap_reason", reason).withColumns({"fx_": F.coalesce(fallback_x, own["x"]), "fy_": F.coalesce(fallback_y, own["y"])})
    square = geo.box_ring(F.col("fx_") - HALF_M, F.col("fy_") - HALF_M, F.col("fx_") + HALF_M, F.col("fy_") + HALF_M)
    return d.withColumn("footprint", F.when(F.col("cap_reason").isNull(), F.col(ring)).otherwise(square)).drop("fx_", "fy_")


def fallback_seed(sites: DataFrame, matched: DataFrame) -> DataFrame:
    """(site_id, lat, lon): a seed on the site's representative parcel, the plant's own point first, then an independent one; else the site's mean."""
    on = matched.join(sites.select("site_id", F.col("rep_ll_uuid").alias("ll_uuid")), ["site_id", "ll_uuid"])
    best = on.groupBy("site_id").agg(F.min(F.struct(F.col("source") != "cwns_point", ~F.col("independent"), "seed", "lat", "lon")).alias("b"))
    d = sites.select("site_id", "site_lat", "site_lon").join(best, "site_id", "left")
    return d.select("site_id", F.coalesce("b.lat", "site_lat").alias("lat"), F.coalesce("b.lon", "site_lon").alias("lon"))


def analysis_region(df: DataFrame, window_m: float, max_km2: float, max_extent_m: float, clip_m: float, ring: str = "ring") -> DataFrame:
    """df (x, y, ring) with oversized (area, extent or null), clipped and bx0 .. by1: the window around the point, joined by the parcel's box
    unless that is oversized, clipped to a square of clip_m."""
    x0, y0, x1, y1 = bounds(F.col(ring))
    h, m = window_m / 2, clip_m / 2
    over = F.when(geo.ring_area(F.col(ring)) / 1e6 > max_km2, "area").when(F.greatest(x1 - x0, y1 - y0) > max_extent_m, "extent")
    d = df.withColumn("oversized", over)
    use = F.col(ring).isNotNull() & F.col("oversized").isNull()
    full = [F.when(use, F.least(F.col("x") - h, x0)).otherwise(F.col("x") - h), F.when(use, F.least(F.col("y") - h, y0)).otherwise(F.col("y") - h), F.when(use, F.greatest(F.col("x") + h, x1)).otherwise(F.col("x") + h), F.when(use, F.greatest(F.col("y") + h, y1)).otherwise(F.col("y") + h)]
    clip = [F.greatest(full[0], F.col("x") - m), F.greatest(full[1], F.col("y") - m), F.least(full[2], F.col("x") + m), F.least(full[3], F.col("y") + m)]
    bit = use & ((clip[0] != full[0]) | (clip[1] != full[1]) | (clip[2] != full[2]) | (clip[3] != full[3]))
    return d.withColumns({"clipped": bit, "bx0": clip[0], "by0": clip[1], "bx1": clip[2], "by1": clip[3]})


def coordinate(objects: DataFrame, key: str, strategy: str, origin: DataFrame | None = None) -> DataFrame:
    """(key, lat, lon) of objects (key, id, lat, lon, conf): weighted_centroid, highest_confidence or closest_to_original (origin: key, olat, olon)."""
    if strategy == "weighted_centroid":
        w = F.sum("conf")
        return objects.groupBy(key).agg((F.sum(F.col("lat") * F.col("conf")) / w).alias("lat"), (F.sum(F.col("lon") * F.col("conf")) / w).alias("lon"))
    if strategy == "highest_confidence":
        best = F.min(F.struct(-F.col("conf"), "id", "lat", "lon"))
    else:
        objects = objects.join(origin, key).withColumn("d_", geo.equirectangular_m(F.col("lat"), F.col("lon"), F.col("olat"), F.col("olon")))
        best = F.min(F.struct("d_", "id", "lat", "lon"))
    return objects.groupBy(key).agg(best.alias("b")).select(key, "b.lat", "b.lon")


def merge_overlaps(df: DataFrame, plant: str, fraction: float = 0.3) -> DataFrame:
    """(plant, id, role) of boxes (plant, ord, id, role, x0, y0, x1, y1): in order, a box takes those later ones that overlap by more than
    the fraction of the smaller; a merged row is reported if one of them is, else has the first role."""

    def solve(rows: list[dict]) -> list:
        rows = sorted(rows, key=lambda r: r["ord"])
        used, out = set(), []
        size = lambda r: (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])
        for i, a in enumerate(rows):
            if i in used:
                continue
            used.add(i)
            roles = {a["role"]}
            for j, b in enumerate(rows):
                if j in used:
                    continue
                w, h = min(a["x1"], b["x1"]) - max(a["x0"], b["x0"]), min(a["y1"], b["y1"]) - max(a["y0"], b["y0"])
                low = min(size(a), size(b))
                if w > 0 and h > 0 and low > 0 and w * h / low > fraction:
                    roles.add(b["role"])
                    used.add(j)
            out.append([a[plant], a["id"], "reported" if "reported" in roles else min(roles)])
        return out

    kinds = dict(df.dtypes)
    return cluster.by_group(df, [plant], solve, f"{plant} {kinds[plant]}, id {kinds['id']}, role string")


def close_pairs(df: DataFrame, by: list[str], key: str, metres: float) -> DataFrame:
    """(by, a, b, dist_m): pairs of one group (by, key, lat, lon) at most metres apart."""
    r = df.select(*[F.col(c).alias(f"r_{c}") for c in by], F.col(key).alias("b"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    p = joins.within_distance(df, r, metres).where(F.col(key) < F.col("b"))
    for c in by:
        p = p.where(F.col(c).eqNullSafe(F.col(f"r_{c}")))
    return p.select(*by, F.col(key).alias("a"), "b", "dist_m")


def within_buffer(points: DataFrame, areas: DataFrame, metres: float, cell: float) -> DataFrame:
    """points (x, y, ...) with the areas (area, ring) that come within metres of them."""
    x0, y0, x1, y1 = bounds(F.col("ring"))
    boxes = areas.withColumns({"x0": x0 - metres, "y0": y0 - metres, "x1": x1 + metres, "y1": y1 + metres})
    return joins.points_in_boxes(points, boxes, cell, geo.ring_distance(F.col("ring"), F.col("x"), F.col("y")) <= metres).drop("ring", "x0", "y0", "x1", "y1")


def contains_pairs(pairs: DataFrame, points: DataFrame, areas: DataFrame) -> DataFrame:
    """pairs (point, area) with inside: whether the given area's ring holds the given point."""
    d = pairs.join(points.select("point", "x", "y"), "point", "left").join(areas.select("area", "ring"), "area", "left")
    return d.select(*pairs.columns, F.coalesce(geo.in_ring(F.col("ring"), F.col("x"), F.col("y")), F.lit(False)).alias("inside"))


def cells_of_box(df: DataFrame, size: float = 190.5, step: float = 80.0) -> DataFrame:
    """df (x0, y0, x1, y1) with the hex cells (q, r) of an 80 m sampling of the box, and one ring more."""
    n = lambda a, b: F.sequence(F.lit(0), F.ceil((F.col(b) - F.col(a)) / step).cast("int"))
    d = df.withColumn("i_", F.explode(n("x0", "x1"))).withColumn("j_", F.explode(n("y0", "y1")))
    q, r = geo.hex_cell(F.least(F.col("x1"), F.col("x0") + F.col("i_") * step), F.least(F.col("y1"), F.col("y0") + F.col("j_") * step), size)
    return joins.disk(d.select(*df.columns, q.alias("q"), r.alias("r")).distinct(), 1)


def view(points: DataFrame, west: float, south: float, east: float, north: float, key: str, most: int = MAX_VIEW_ROWS) -> tuple[DataFrame, bool, bool]:
    """(rows, too_big, truncated) of points (key, lat, lon) in a map window: none if the window is too big, at most `most` by key."""
    width, height = (east - west) * 111.32 * math.cos(math.radians((south + north) / 2)), (north - south) * 110.57
    if width > MAX_VIEW_KM or height > MAX_VIEW_KM:
        return points.limit(0), True, False
    rows = points.where(F.col("lat").between(south, north) & F.col("lon").between(west, east)).orderBy(key).limit(most + 1)
    n = rows.count()  # at most `most` and one
    return rows.limit(most), False, n > most


def states_near(plants: DataFrame, west: float, south: float, east: float, north: float, pad: float = 0.25) -> DataFrame:
    """(state) of the plants (state, lat, lon) in the padded window; the state of the plant nearest to its centre if there is none."""
    inside = F.col("lat").between(south - pad, north + pad) & F.col("lon").between(west - pad, east + pad)
    d = F.pow(F.col("lon") - (west + east) / 2, 2) + F.pow(F.col("lat") - (south + north) / 2, 2)
    g = plants.where("state <> ''").groupBy("state").agg(F.bool_or(inside).alias("near"), F.min(d).alias("d"))
    best = g.agg(F.bool_or("near").alias("any"), F.min(F.struct("d", "state"))["state"].alias("first"))
    return g.join(F.broadcast(best)).where(F.when(F.col("any"), F.col("near")).otherwise(F.col("state") == F.col("first"))).select("state")


def keepers(df: DataFrame, group: str, key: str, preferred: Column) -> DataFrame:
    """df (group, key, labelled) with action: a labelled row is kept; several labelled are a conflict and nothing goes; without one the
    first (preferred rows first, then by key) is kept and the others are dropped."""
    n = F.count_if("labelled").over(W.partitionBy(group))
    first = F.row_number().over(W.partitionBy(group).orderBy(~F.coalesce(preferred, F.lit(False)), key))
    d = df.withColumns({"n_": n, "f_": first})
    action = F.when((F.col("n_") > 1) & F.col("labelled"), "conflict").when(F.col("n_") > 1, "keep").when(F.col("n_") == 1, F.when(F.col("labelled"), "keep").otherwise("drop")).when(F.col("f_") == 1, "keep").otherwise("drop")
    return d.withColumn("action", action).drop("n_", "f_")


def coverage(zones: DataFrame, pixel_m: float, raster: tuple[int, int] | None = None) -> DataFrame:
    """(zone, px, py, share) of the pixels that a zone's ring (zone, ring) touches: which share of each it covers.

    raster: columns and rows of the raster from pixel (0, 0) on, which has no others; without it the plane has no end.
    """
    x0, y0, x1, y1 = bounds(F.col("ring"))
    at = lambda c: F.floor(c / pixel_m).cast("bigint")

    def pixels(low, high, n):
        if n is None:
            return F.sequence(at(low), at(high))
        first, last = F.greatest(at(low), F.lit(0)), F.least(at(high), F.lit(n - 1))
        return F.when(first <= last, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<bigint>"))

    nx, ny = raster or (None, None)
    d = zones.withColumn("px", F.explode(pixels(x0, x1, nx))).withColumn("py", F.explode(pixels(y0, y1, ny)))
    px, py = F.col("px") * pixel_m, F.col("py") * pixel_m
    share = geo.box_overlap(F.col("ring"), px, py, px + pixel_m, py + pixel_m) / (pixel_m * pixel_m)
    return d.select("zone", "px", "py", share.alias("share")).where("share > 0")


def zonal(zones: DataFrame, pixels: DataFrame, pixel_m: float, water: int = 11) -> DataFrame:
    """(zone, pixels, water, dominant, from_centroid) of zones (zone, ring): pixels (px, py, value) that are at least half covered count;
    a zone too small for one takes the pixel under its centroid and is flagged."""
    at = lambda c: F.floor(c / pixel_m).cast("bigint")
    d = coverage(zones, pixel_m).where("share >= 0.5")
    c = geo.centroid(F.col("ring"))
    under = zones.select("zone", at(c["x"]).alias("px"), at(c["y"]).alias("py")).join(pixels, ["px", "py"]).select("zone", F.col("value").alias("under"))
    counts = d.join(pixels, ["px", "py"]).where("value is not null").groupBy("zone", "value").agg(F.count(F.lit(1)).alias("n"))
    z = counts.groupBy("zone").agg(F.sum("n").alias("pixels"), F.sum(F.when(F.col("value") == water, F.col("n")).otherwise(0)).alias("water"), F.min(F.struct(-F.col("n"), "value"))["value"].alias("dominant"))
    out = zones.select("zone").join(z, "zone", "left").join(under, "zone", "left")
    return out.select("zone", F.coalesce("pixels", F.lit(0)).alias("pixels"), F.coalesce("water", F.lit(0)).alias("water"), F.coalesce("dominant", "under").alias("dominant"), (F.col("pixels").isNull() & F.col("under").isNotNull()).alias("from_centroid"))


def sample_pixels(points: DataFrame, pixels: DataFrame, pixel_m: float) -> DataFrame:
    """points (x, y) with the value of the pixel (px, py, value) they fall on, null without one."""
    at = lambda c: F.floor(F.col(c) / pixel_m).cast("bigint")
    return points.withColumns({"px": at("x"), "py": at("y")}).join(pixels, ["px", "py"], "left").drop("px", "py")
