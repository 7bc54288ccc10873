"""Text normalisers, name tokens and address rules as Column expressions."""
from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Word lists, placeholders and patterns that results depend on.
STOPWORDS = "of the and a an at for in on to".split()
ABBREVIATIONS = {
    "wwtp": "wastewater treatment plant", "wwtf": "wastewater treatment facility", "wtp": "treatment plant", "stp": "sewage treatment plant",
    "wpcp": "water pollution control plant", "wpcf": "water pollution control facility", "wrf": "water reclamation facility",
    "wrrf": "water resource recovery facility", "wrp": "water reclamation plant", "potw": "publicly owned treatment works",
    "sd": "sanitary district", "msd": "metropolitan sewer district", "psd": "public service district", "mud": "municipal utility district",
    "mua": "municipal utilities authority", "ua": "utilities authority", "sa": "sewer authority", "wsa": "water sewer authority",
    "co": "county", "cnty": "county", "cty": "city", "twp": "township", "vlg": "village", "vill": "village", "boro": "borough", "bor": "borough",
    "auth": "authority", "dist": "district", "dst": "district", "muni": "municipal", "mun": "municipal", "reg": "regional", "regl": "regional",
    "trtmt": "treatment", "trmt": "treatment", "trt": "treatment", "plt": "plant", "fac": "facility", "wtr": "water", "swr": "sewer",
    "dept": "department", "comm": "commission", "commrs": "commissioners", "st": "saint", "mt": "mount", "ft": "fort", "no": "number",
}
GENERIC = (
    "the of and at for in on to a an wastewater waste water sewer sewage sewerage sanitary sanitation treatment plant plants facility facilities "
    "works reclamation recovery resource pollution control lagoon lagoons pond ponds system systems utility utilities authority district "
    "department commission commissioners board service services public publicly owned municipal metropolitan regional joint city town township "
    "village borough county state parish inc llc corp corporation company ltd lp trust number east west north south upper lower new old main "
    "collection sewers aka"
).split()
PLACEHOLDERS = ["NULL", "NONE", "N/A", "NA", "UNKNOWN", "UNK", "TBD", "-", ".", "0", "?"]
PO_BOX = r"\b(?:P\.? ?O\.? ?BOX|POST OFFICE BOX|BOX [0-9]+)\b"
COUNTY_ONLY = r"^(?:IN |IN THE )?[A-Z .'\-]+ (?:COUNTY|PARISH)$"
SECTION = r"\bSEC(?:TION|\.)? ?[0-9]|\bT[0-9]+[NS]\b|\bR[0-9]+[EW]\b|\bTWNSH|\bTWP\b|\bRNG\b|\b[NS][EW]Q\b|\bQUARTER\b"
INTERSECTION = r"(?:&|\bAND\b|\bINT\.? |\bINTERSECTION\b| AT )"
DESCRIPTIVE = r"\b(?:MI|MILES?|FEET|FT|ADJ|ADJACENT|NEAR|BEHIND|NORTH OF|SOUTH OF|EAST OF|WEST OF|OFF OF)\b|\b[NSEW]{1,2} OF\b"
CIVIC = r"\b(?:CITY|TOWN|VILLAGE|BOROUGH|TOWNSHIP|COUNTY) (?:HALL|OFFICE|BUILDING)\b|\bMUNICIPAL (?:BUILDING|CENTER|COMPLEX)\b|\bCOURTHOUSE\b"
GEO_REMOVED = r"cdp|municipio|municipality|parish|city|st\.|borough|district|census area|town|village|ccd|township|barrio|precinct|census subarea"
OWNER_FLAGS = {
    "owner_is_person": "etux|sfr|borrower|surv",
    "owner_is_govt": "city|county|municipality|municipal|district|authority|auth|township|borough|state|federal|dept|department|board|commission|muni|pub|wtr|commonw|commwlth",
    "owner_is_utility": "water|sewer|wastewater|utility|utilities|sanitary|sanitation|treatment|wwtp|wsd|msd|puc|pwd|mwrd|wpcp|potw|sewerage|wtf|wwtf",
    "owner_is_electric": "electric|elec|power|energy|entergy|grid|verizon|telecom|telephone|tel|tele|hydropower|centerpoint|oncor|niagara|nyseg|xcel",
    "owner_has_llc_corp": "llc|inc|corp|ltd|lp|company|association|trust|partners|partnership|holdings|ventures|properties|realty|development|developer|builders|homes|lennar|pulte|horton|forestar",
}
SOURCE_NAMES = {
    "cwns_point": "CWNS coordinate", "cwns_addr": "CWNS address geocode", "icis_fac_frs": "ICIS facility coordinate (FRS)", "icis_fac_addr": "ICIS address geocode",
    "icis_feat_INF": "ICIS permit feature (INF/INO)", "icis_feat_INO": "ICIS permit feature (INF/INO)",
}
STREET_NUMBER = r"^[0-9]+[A-Z]?(?:[-/][0-9A-Z]+)?\s+(?:[NSEW]{1,2}\.?\s+)?[A-Z0-9]"


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def clean_place(c: Column) -> Column:
    """A place name less the words for kinds of places, wherever they occur."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(c), GEO_REMOVED, "")), r"\s+", " ")


def owner_flags(c: Column) -> dict[str, Column]:
    """Whole-word flags of an owner's text; two plain words are a person too."""
    clean = squeeze(F.coalesce(c, F.lit("")))
    flags = {k: clean.rlike(rf"\b({v})\b") for k, v in OWNER_FLAGS.items()}
    return flags | {"owner_is_person": flags["owner_is_person"] | clean.rlike("^[a-z]+ [a-z]+$")}


def source_category(sources: Column) -> Column:
    """One category for a joined source list (a+b): the common one, the pair of address geocodes, else a tie; null for none."""
    parts = F.array_distinct(F.split(sources, r"\+"))
    names = F.create_map(*[F.lit(x) for pair in SOURCE_NAMES.items() for x in pair])
    cats = F.array_distinct(F.transform(parts, lambda s: names[s]))
    both = F.array_sort(parts) == F.array(F.lit("cwns_addr"), F.lit("icis_fac_addr"))
    return F.when(F.coalesce(sources, F.lit("")) == "", F.lit(None)).when(both, "Both address geocodes (same point)").when(F.size(cats) == 1, F.get(cats, 0)).otherwise("Tie: several sources")


def tile_name(c: Column) -> Column:
    """struct(site, stem) of a label file's name: an 11-digit plant, an optional parcel and a tile, or TRI_ and a tile; null for others."""
    name = F.regexp_replace(c, r"\.txt$", "")
    name = F.when(name.contains("%5C"), F.substring_index(name, "%5C", -1)).otherwise(F.regexp_replace(name, "^[0-9a-f]{8}[-_]", ""))
    name = F.regexp_replace(name, "_rgb$", "")
    plant, other = r"^([0-9]{11})_(?:[0-9A-Fa-f-]{36}_)?(?:r[0-9]+_c[0-9]+|500m)$", r"^TRI_([A-Za-z0-9]+)_(r[0-9]+_c[0-9]+)$"
    site = F.when(name.rlike(plant), F.regexp_extract(name, plant, 1)).when(name.rlike(other), F.concat(F.lit("TRI_"), F.regexp_extract(name, other, 1)))
    return F.when(site.isNotNull(), F.struct(site.alias("site"), name.alias("stem")))


def dhash(grid: Column, width: int) -> Column:
    """Difference hash of a picture's grey values, row by row, as bits: whether each is darker than the one to its right."""
    bits = F.transform(F.filter(F.sequence(F.lit(0), F.size(grid) - 2), lambda i: (i + 1) % width != 0), lambda i: F.when(F.get(grid, i + 1) > F.get(grid, i), "1").otherwise("0"))
    return F.array_join(bits, "")


def norm_owner(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", " "), " +", " "))


def norm_name(c: Column) -> Column:
    """& to and, # to number, letters and digits apart, the rest to spaces, abbreviations written out; null is ''."""
    c = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "&", " and "), "#", " number ")
    c = F.regexp_replace(F.regexp_replace(c, "([a-z])([0-9])", "$1 $2"), "([0-9])([a-z])", "$1 $2")
    tokens = F.split(F.trim(F.regexp_replace(c, "[^a-z0-9]+", " ")), " ")
    known = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    return F.array_join(F.transform(tokens, lambda t: F.coalesce(known[t], t)), " ")


def distinctive_of(norm: Column) -> Column:
    """Of a normalised name: tokens that tell it from others (not generic, not numbers, two letters or more), first occurrence kept."""
    return F.array_distinct(F.filter(F.split(norm, " "), lambda t: (F.length(t) >= 2) & ~t.rlike("^[0-9]+$") & ~t.isin(*GENERIC)))


def distinctive(c: Column) -> Column:
    return distinctive_of(norm_name(c))


def initials_of(norm: Column) -> Column:
    return F.array_join(F.transform(F.filter(F.split(norm, " "), lambda t: ~t.rlike("^[0-9]+$") & ~t.isin(*STOPWORDS, "")), lambda t: F.substring(t, 1, 1)), "")


def initials(c: Column) -> Column:
    """First letters of a name's words, without stop words and numbers."""
    return initials_of(norm_name(c))


def raw_tokens(c: Column) -> Column:
    """Tokens before abbreviations are written out, & removed: acronyms stay whole."""
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "&", ""), "[^a-z0-9]+"), lambda t: t != "")


def acronym_like(token: Column) -> Column:
    return token.rlike("^[a-z]{3,7}$")


def acronym_hit(token: Column, inits: Column) -> Column:
    """A token of 3 to 7 letters and initials of 3 or more: equal, or the shorter is a prefix or suffix of the longer."""
    short = F.when(F.length(token) <= F.length(inits), token).otherwise(inits)
    long = F.when(F.length(token) <= F.length(inits), inits).otherwise(token)
    return acronym_like(token) & (F.length(inits) >= 3) & (long.startswith(short) | long.endswith(short))


def clean_placeholder(c: Column) -> Column:
    """Blanks collapsed; what only stands for no value becomes ''."""
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.when(F.upper(t).isin(*PLACEHOLDERS), F.lit("")).otherwise(t)


def zip5(c: Column) -> Column:
    d = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    return F.when(F.length(d) >= 5, F.substring(d, 1, 5)).otherwise("")


def address_class(c: Column) -> Column:
    """What kind of text a cleaned address line is; the first rule that holds."""
    u = F.upper(F.coalesce(c, F.lit("")))
    rules = [("po_box", PO_BOX), ("county_only", COUNTY_ONLY), ("plss", SECTION), ("descriptive", DESCRIPTIVE), ("intersection", INTERSECTION), ("street_number", STREET_NUMBER)]
    out = F.when(u == "", "missing")
    for name, pattern in rules:
        out = out.when(u.rlike(pattern), name)
    return out.otherwise("road_no_number")


def pick_street(first: Column, second: Column) -> Column:
    """struct(street, other, po_box) of two cleaned lines: the line of the best class, the other line if it says more, the box line."""
    kinds = ["street_number", "intersection", "road_no_number", "descriptive", "plss"]
    c1, c2 = address_class(first), address_class(second)
    alone = F.upper(first) == F.upper(second)
    rank = lambda c: F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(k) for k in kinds]), c), F.lit(0)), F.lit(99))
    r1, r2 = rank(c1), F.when(alone, F.lit(99)).otherwise(rank(c2))
    takes_first, takes_second = (r1 <= r2) & (r1 < 99), (r2 < r1) & (r2 < 99)
    street = F.when(takes_first, first).when(takes_second, second).otherwise("")
    other = F.when(takes_first & ~alone & (rank(c2) < 99) & (second != first), second).when(takes_second & (r1 < 99), first).otherwise("")
    box = F.when(c1 == "po_box", first).when(c2 == "po_box", second).otherwise("")
    return F.struct(street.alias("street"), other.alias("other"), box.alias("po_box"))


def expected_precision(kind: Column, city: Column, zip_: Column) -> Column:
    """none without city and zip; else what a geocoder can reach with this kind of line."""
    there = (city != "") | (zip_ != "")
    return F.when(~there, "none").when(kind == "street_number", "address").when(kind.isin("road_no_number", "intersection"), "street").otherwise("locality")


def civic(c: Column) -> Column:
    return F.upper(c).rlike(CIVIC)


def address_key(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.upper(F.coalesce(p, F.lit(""))) for p in parts])


def mentions(text: Column, term: Column) -> Column:
    """Tri-state: null without a term, else whether the lower-case text holds it literally."""
    t = F.trim(F.lower(term))
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit(None).cast("boolean")).otherwise(F.lower(F.coalesce(text, F.lit(""))).contains(t))


def keep_ends(c: Column, head: int, tail: int) -> Column:
    """A log text with what carriage returns overwrote removed, cut in the middle to head + tail characters."""
    c = F.coalesce(c, F.lit(""))
    c = F.when(c.contains("\r"), F.regexp_replace(c, r"[^\n]*\r(?!\n)", "")).otherwise(c)
    return F.when(F.length(c) <= head + tail, c).otherwise(F.concat(F.substring(c, 1, head), F.lit("\n...\n"), F.substring(c, -tail, tail)))


def signature(labels: Column) -> Column:
    """Canonical text of array<struct<...>> numbers: rounded to four places and sorted, so that order and noise don't matter."""
    return F.array_join(F.array_sort(labels), ";")


def hash_fraction(c: Column) -> Column:
    """sha1 of an id, first 8 hex digits over 2^32: a stable number in [0, 1)."""
    return F.conv(F.substring(F.sha1(c.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_seed(c: Column, modulus: int = 10000) -> Column:
    return F.conv(F.substring(F.sha2(c.cast("string").cast("binary"), 256), 1, 8), 16, 10).cast("bigint") % modulus


def _lcs(a: str, b: str) -> int:
    """Bit-parallel longest common subsequence."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 * 2 LCS / (len a + len b); 100 for two empty strings, null with a null."""
    def one(x, y):
        if x is None or y is None:
            return None
        return 200.0 * _lcs(x, y) / (len(x) + len(y)) if x or y else 100.0

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")
