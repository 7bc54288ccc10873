"""Value maps, bands and validity rules of plants and parcels as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Descriptions by class, land cover codes by class.
ACTIVITY = {
    "Water Utility": [
        "Activities associated with utilities (water, sewer, power, etc.)", "Health care, medical, or treatment", "Industrial, manufacturing, and waste-related", "Sewer-related control, monitor, or distribution",
        "Sewer treatment and processing", "Social, institutional, or infrastructure-related", "Solid waste management", "Water-supply-related", "Water purification and filtration", "Water storing, pumping, or piping",
    ],
    "Utility Other": [
        "Power generation, control, monitor, or distribution", "Power generation, storage, or processing", "Power transmission lines or control", "Storage of natural gas, fuels, etc.",
        "Telecommunications-related control, monitor, or distribution",
    ],
    "Agriculture": ["Farming, tilling, plowing, harvesting, or related", "Livestock related", "Logging", "Mining including surface and subsurface strip mining", "Pasturing, grazing, etc."],
    "Vacant": ["Agricultural vacant land", "Vacant parcel", "Vacant parcel, undevelopable", "Commercial vacant land", "Residential vacant land", "Industrial vacant land"],
    "Leisure": [
        "Leisure", "Boating, sailing, etc.", "Camping", "Golf", "Sailing, boating, and other port, marine and water-based", "Promenading and other activities in parks", "Passive leisure activity",
        "Gatherings at fairs and exhibitions", "Hockey, ice skating, etc.", "Skiing, snowboarding, etc.",
    ],
    "Commercial": [
        "Movies, concerts, or entertainment shows", "Goods-oriented shopping", "Service-oriented shopping", "Shopping", "Shopping, business, or trade", "Restaurant-type activity", "Restaurant-type activity with drive-through",
    ],
    "Household": ["Household", "Residential"],
    "Unknown": ["Unknown"],
}
FUNCTION_UTILITY = ["Waste treatment and disposal", "Utilities and utility services", "Transportation, communication, information, and utilities", "Sewer, solid waste, and related services"]
OWNERSHIP = {
    "Government": ["City, Village, Township, etc.", "State government", "Federal government", "County, Parish, Province, etc."],
    "Private": ["Private persons and private joint ownership", "Private trusts"],
    "Commercial": ["Businesses and commercial entities"],
}
LAND_COVER = {"Open Water": [11], "Developed": [21, 22, 23, 24], "Forest": [41, 42, 43], "Agriculture": [81, 82], "Wetland": [90, 95], "Barren/Shrub/Grassland": [31, 52, 71]}


def mapped(c: Column, classes: dict[str, list], other: str, missing: str) -> Column:
    """The class that lists the value, `missing` for null, `other` for what no class lists."""
    out = F.when(c.isNull(), missing)
    for name, values in classes.items():
        out = out.when(c.isin(*values), name)
    return out.otherwise(other)


def activity(c: Column) -> Column:
    return mapped(c, ACTIVITY, "Other", "Unknown")


def land_use(c: Column) -> Column:
    return mapped(c, {"Utility": FUNCTION_UTILITY}, "Other", "Unknown")


def ownership(c: Column) -> Column:
    return mapped(c, OWNERSHIP, "Other / Unknown", "Other / Unknown")


def land_cover(c: Column) -> Column:
    return mapped(c.cast("int"), LAND_COVER, "Other", "Unknown")


def population_band(c: Column) -> Column:
    """100-1k is over 100 and at most 1000."""
    return F.when(c.isNull(), "unknown").when(c > 1000, ">1k").when(c > 100, "100-1k").otherwise("below_floor")


def above_floor(df: DataFrame, population: DataFrame, key: str, value: str, floor: float) -> DataFrame:
    """df's rows whose population (key, value) is over the floor; unknown or non-numeric is excluded, floor 0 lets all pass."""
    if floor <= 0:
        return df
    return df.join(population.where(F.col(value).try_cast("double") > floor).select(key), key, "left_semi")


def coordinates_valid(lat: Column, lon: Column) -> Column:
    """On the continent, in Alaska, Hawaii and the islands of either ocean; null is not valid."""
    return F.coalesce((lat.between(17, 72) & lon.between(-180, -60)) | (lat.between(5, 25) & lon.between(130, 180)), F.lit(False))


def numeric(df: DataFrame, columns: list[str], required: list[str] = ()) -> DataFrame:
    """df with columns as numbers, bad ones null, and without the rows that lack a required one."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns}).na.drop(subset=list(required)) if required else df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def share(part: Column, total: Column) -> Column:
    """part / total, 0 where there is no total."""
    return F.when(total > 0, part / total).otherwise(0.0)


def alive_since(ended: Column, cutoff: Column) -> Column:
    """Not ended, or not before the cutoff."""
    return ended.isNull() | (ended >= cutoff)


def site_label(site: Column, truth: Column, reported: Column) -> Column:
    """Correct if a site's parcels meet the true ones, Incorrect if the truth is known or the site holds the reported one, else null."""
    return F.when(F.arrays_overlap(site, truth), "Correct").when((F.size(truth) > 0) | F.array_contains(site, reported), "Incorrect")


def reasons(flags: dict[str, Column]) -> tuple[Column, Column]:
    """(reasons joined by comma in the order given, the first one's place or null)."""
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"))) for i, (k, c) in enumerate(flags.items(), 1)]))
    return F.array_join(F.transform(found, lambda x: x["k"]), ","), F.get(found, 0)["i"]


def in_box(lat: Column, lon: Column, west: float, south: float, east: float, north: float) -> Column:
    return lat.between(south, north) & lon.between(west, east)
