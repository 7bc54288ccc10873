"""Projections, CASE cascades and scalar functions."""
from __future__ import annotations

from pyspark.sql import functions as F

from siteforge.functions import classes, geo, text
from siteforge.operators import vectors
from siteforge.plans.points import LAT, LON, lat, lon
from siteforge.plans.registry import query
from siteforge.sources.tables import table


@query("p1_coerce", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k, try_cast(event_type AS DOUBLE) AS bad FROM events")
def p1_coerce(spark, sf_dir):
    """Bad numbers become null."""
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("double").alias("k"), F.col("event_type").try_cast("double").alias("bad"))


@query("p2_population_floor", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 1000)")
def p2_population_floor(spark, sf_dir):
    """Strictly above the floor; unknown is excluded."""
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    return classes.above_floor(table(spark, sf_dir, "orders"), people, "o_custkey", "c_acctbal", 1000).select("o_orderkey")


@query("p3_bands", "SELECT c_custkey, CASE WHEN c_acctbal IS NULL THEN 'unknown' WHEN c_acctbal > 1000 THEN '>1k' WHEN c_acctbal > 100 THEN '100-1k' ELSE 'below_floor' END AS band FROM customer")
def p3_bands(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", classes.population_band(F.col("c_acctbal")).alias("band"))


_FARLAT, _FARLON = "(c_custkey * 7919 % 90000) / 1000.0::DOUBLE", "((c_custkey * 104729 % 360000) / 1000.0::DOUBLE - 180)"


@query("p4_coordinates", f"SELECT c_custkey FROM customer WHERE ({_FARLAT} BETWEEN 17 AND 72 AND {_FARLON} BETWEEN -180 AND -60) OR ({_FARLAT} BETWEEN 5 AND 25 AND {_FARLON} BETWEEN 130 AND 180)")
def p4_coordinates(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(classes.coordinates_valid((k * 7919 % 90000) / 1000.0, (k * 104729 % 360000) / 1000.0 - 180)).select("c_custkey")


def _listed(values: dict) -> list:
    return [v for vs in values.values() for v in vs]


def _case(c: str, values: dict, other: str, missing: str) -> str:
    q = lambda v: repr(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"CASE WHEN {c} IS NULL THEN '{missing}' " + " ".join(f"WHEN {c} IN ({', '.join(map(q, vs))}) THEN '{k}'" for k, vs in values.items()) + f" ELSE '{other}' END"


def _pick(items: list, key, modulus: int):
    """One of the items by the key, null and an unlisted value among them."""
    return F.get(F.array(*[F.lit(x) for x in [*items, "something else", None]]), (key % modulus).cast("int"))


_ACT, _OWNERS = _listed(classes.ACTIVITY), _listed(classes.OWNERSHIP)
_SQL_LIST = lambda items: "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in [*items, "something else"]) + ", NULL]"


@query("p5_value_map", f"SELECT o_orderkey, {_case('v', classes.ACTIVITY, 'Other', 'Unknown')} AS v FROM (SELECT o_orderkey, {_SQL_LIST(_ACT)}[1 + o_orderkey % {len(_ACT) + 2}] AS v FROM orders)")
def p5_value_map(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", classes.activity(_pick(_ACT, F.col("o_orderkey"), len(_ACT) + 2)).alias("v"))


@query("p6_reclass", f"SELECT p_partkey, {_case('o', classes.OWNERSHIP, 'Other / Unknown', 'Other / Unknown')} AS o, {_case('u', {'Utility': classes.FUNCTION_UTILITY}, 'Other', 'Unknown')} AS u FROM (SELECT p_partkey, {_SQL_LIST(_OWNERS)}[1 + p_partkey % {len(_OWNERS) + 2}] AS o, {_SQL_LIST(classes.FUNCTION_UTILITY)}[1 + p_partkey % {len(classes.FUNCTION_UTILITY) + 2}] AS u FROM part)")
def p6_reclass(spark, sf_dir):
    k = F.col("p_partkey")
    use = _pick(classes.FUNCTION_UTILITY, k, len(classes.FUNCTION_UTILITY) + 2)
    return table(spark, sf_dir, "part").select("p_partkey", classes.ownership(_pick(_OWNERS, k, len(_OWNERS) + 2)).alias("o"), classes.land_use(use).alias("u"))


@query("p7_code_groups", f"SELECT p_partkey, {_case('c', classes.LAND_COVER, 'Other', 'Unknown')} AS g FROM (SELECT p_partkey, CASE WHEN p_partkey % 97 > 95 THEN NULL ELSE p_partkey % 97 END AS c FROM part)")
def p7_code_groups(spark, sf_dir):
    k = F.col("p_partkey") % 97
    return table(spark, sf_dir, "part").select("p_partkey", classes.land_cover(F.when(k <= 95, k)).alias("g"))


@query("p8_log_ratio", "SELECT l_orderkey, l_linenumber, l_partkey, round(ln(1 + coalesce(l_extendedprice, 0)), 9) AS lg, round(l_extendedprice / nullif(l_tax, 0), 6) AS ratio FROM lineitem")
def p8_log_ratio(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.log1p(F.coalesce("l_extendedprice", F.lit(0.0))), 9).alias("lg"), F.round(F.try_divide(F.col("l_extendedprice"), F.col("l_tax")), 6).alias("ratio"))


@query("p9_share_default", "SELECT l_orderkey, CASE WHEN sum(l_quantity) > 0 THEN sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity) ELSE 0 END AS share FROM lineitem GROUP BY 1")
def p9_share_default(spark, sf_dir):
    t, w = F.sum("l_quantity"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(classes.share(w, t).alias("share"))


@query(
    "p11_status_cascade",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'verified_correct' WHEN o_orderstatus = 'F' THEN 'verified_corrected' WHEN o_orderpriority = '5-LOW' THEN 'reviewed_unresolved'
    WHEN o_totalprice < 20000 THEN 'not_assessed' WHEN o_orderpriority = '1-URGENT' THEN 'kept_osm' WHEN o_totalprice > 250000 THEN 'kept_model' WHEN o_custkey % 2 = 0 THEN 'flagged_not_moved' ELSE 'moved' END AS status,
    CASE WHEN o_orderstatus = 'F' THEN 'verified' WHEN o_totalprice > 250000 THEN 'model' WHEN o_totalprice > 100000 THEN 'model_small_plant' ELSE 'none' END AS tier FROM orders""",
)
def p11_status_cascade(spark, sf_dir):
    """First match wins; the tier is a cascade of its own (P10 to P13)."""
    s, p, t = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    status = (
        F.when((s == "F") & (t > 200000), "verified_correct").when(s == "F", "verified_corrected").when(p == "5-LOW", "reviewed_unresolved").when(t < 20000, "not_assessed")
        .when(p == "1-URGENT", "kept_osm").when(t > 250000, "kept_model").when(F.col("o_custkey") % 2 == 0, "flagged_not_moved").otherwise("moved")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), F.when(s == "F", "verified").when(t > 250000, "model").when(t > 100000, "model_small_plant").otherwise("none").alias("tier"))


@query("p18_null_tolerant_dates", "SELECT o_orderkey FROM (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END AS ended FROM orders) WHERE ended IS NULL OR ended >= TIMESTAMP '1997-01-01'")
def p18_null_tolerant_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("ended", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate")))
    return o.where(classes.alive_since(F.col("ended"), F.lit("1997-01-01").cast("timestamp_ntz"))).select("o_orderkey")


@query(
    "p21_site_label",
    "WITH t AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS truth, bool_or(l_linenumber = 1) AS reported, bool_or(l_returnflag = 'R' AND l_quantity > 25) AS hit FROM lineitem GROUP BY 1) SELECT l_orderkey, CASE WHEN hit THEN 'Correct' WHEN truth OR reported THEN 'Incorrect' END AS label FROM t",
)
def p21_site_label(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_set(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("truth_set"), F.collect_set(F.when(F.col("l_quantity") > 25, F.struct("l_partkey", "l_returnflag"))).alias("site"), F.array_contains(F.collect_set("l_linenumber"), 1).alias("reported")
    )
    hit = F.exists("site", lambda x: (x["l_returnflag"] == "R") & F.array_contains(F.col("truth_set"), x["l_partkey"]))
    return g.select("l_orderkey", F.when(hit, "Correct").when((F.size("truth_set") > 0) | F.col("reported"), "Incorrect").alias("label"))


@query(
    "p22_reasons",
    "SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(list_filter([CASE WHEN l_quantity > 40 THEN '1_big' END, CASE WHEN l_discount > 0.08 THEN '2_cheap' END, CASE WHEN l_returnflag = 'R' THEN '3_back' END], lambda x: x IS NOT NULL), ',') AS reasons, CASE WHEN l_quantity > 40 THEN 1 WHEN l_discount > 0.08 THEN 2 WHEN l_returnflag = 'R' THEN 3 END AS priority FROM lineitem",
)
def p22_reasons(spark, sf_dir):
    r, first = classes.reasons({"1_big": F.col("l_quantity") > 40, "2_cheap": F.col("l_discount") > 0.08, "3_back": F.col("l_returnflag") == "R"})
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", r.alias("reasons"), first.alias("priority"))


@query("p28_bbox_limit", f"SELECT c_custkey FROM customer WHERE {LAT.format(k='c_custkey')} BETWEEN 33 AND 36 AND {LON.format(k='c_custkey')} BETWEEN -105 AND -95 ORDER BY c_custkey LIMIT 40")
def p28_bbox_limit(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(classes.in_box(lat(k), lon(k), -105, 33, -95, 36)).select("c_custkey").orderBy("c_custkey").limit(40)


@query("f1_squeeze", "SELECT doc_id, md5(trim(regexp_replace(lower(text), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))) AS h FROM documents")
def f1_squeeze(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.squeeze(F.col("text"))).alias("h"))


_GEO = text.GEO_REMOVED.replace("'", "''")


@query("f2_removals", f"SELECT s_suppkey, regexp_replace(trim(regexp_replace(lower(v), '{_GEO}', '', 'g')), ' +', ' ', 'g') AS v FROM (SELECT s_suppkey, n_name || CASE s_suppkey % 4 WHEN 0 THEN ' City CDP' WHEN 1 THEN ' Township' WHEN 2 THEN ' St. Parish' ELSE '' END AS v FROM supplier JOIN nation ON n_nationkey = s_nationkey)")
def f2_removals(spark, sf_dir):
    d = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    m = F.col("s_suppkey") % 4
    v = F.concat("n_name", F.when(m == 0, " City CDP").when(m == 1, " Township").when(m == 2, " St. Parish").otherwise(""))
    return d.select("s_suppkey", text.clean_place(v).alias("v"))


_OWN = "CASE c_custkey % 9 WHEN 0 THEN 'City of ' WHEN 1 THEN 'Water  Works ' WHEN 2 THEN 'Smith ETUX ' WHEN 3 THEN 'Power Grid ' WHEN 4 THEN 'Green Homes LLC ' WHEN 5 THEN 'John' ELSE '' END || CASE c_custkey % 9 WHEN 5 THEN ' doe' ELSE lower(c_mktsegment) END"


_EDGE = r"\b"


@query("f3_keyword_flags", f"SELECT c_custkey, {', '.join(f"regexp_matches(o, '{_EDGE}({v}){_EDGE}')" + (" OR regexp_full_match(o, '[a-z]+ [a-z]+')" if k == 'owner_is_person' else '') + f' AS {k}' for k, v in text.OWNER_FLAGS.items())} FROM (SELECT c_custkey, trim(regexp_replace(lower({_OWN}), ' +', ' ', 'g')) AS o FROM customer)")
def f3_keyword_flags(spark, sf_dir):
    m = F.col("c_custkey") % 9
    o = F.concat(F.when(m == 0, "City of ").when(m == 1, "Water  Works ").when(m == 2, "Smith ETUX ").when(m == 3, "Power Grid ").when(m == 4, "Green Homes LLC ").when(m == 5, "John").otherwise(""), F.when(m == 5, " doe").otherwise(F.lower("c_mktsegment")))
    return table(spark, sf_dir, "customer").select("c_custkey", *[c.alias(k) for k, c in text.owner_flags(o).items()])


@query("f4_person", "SELECT p_partkey, regexp_full_match(lower(p_name), '[a-z]+ [a-z]+') AS person FROM part")
def f4_person(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.lower("p_name").rlike("^[a-z]+ [a-z]+$").alias("person"))


@query("f5_concat_null_safe", "SELECT p_partkey, coalesce(p_name, '') || ' ' || coalesce(nullif(p_brand, 'Brand#11'), '') || ' ' || coalesce(p_type, '') AS v FROM part")
def f5_concat_null_safe(spark, sf_dir):
    c = lambda x: F.coalesce(x, F.lit(""))
    return table(spark, sf_dir, "part").select("p_partkey", F.concat(c(F.col("p_name")), F.lit(" "), c(F.nullif("p_brand", F.lit("Brand#11"))), F.lit(" "), c(F.col("p_type"))).alias("v"))


@query(
    "f7_norm_name",
    "SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(lower(p_brand), '&', ' and '), '#', ' number '), '([a-z])([0-9])', '\\1 \\2', 'g'), '([0-9])([a-z])', '\\1 \\2', 'g'), '[^a-z0-9]+', ' ', 'g')) AS v FROM part",
)
def f7_norm_name(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.norm_name(F.col("p_brand")).alias("v"))


_STOP = ", ".join(f"'{w}'" for w in [*text.STOPWORDS, ""])


@query(
    "f9_initials",
    f"SELECT p_partkey, array_to_string(list_transform(list_filter(string_split(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: NOT regexp_matches(x, '^[0-9]+$') AND x NOT IN ({_STOP})), lambda x: x[1]), '') AS ini FROM part",
)
def f9_initials(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.initials(F.col("p_name")).alias("ini"))


@query("f12_norm_owner", "SELECT c_custkey, trim(regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9]', ' ', 'g'), ' +', ' ', 'g')) AS v FROM customer")
def f12_norm_owner(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.norm_owner(F.col("c_name")).alias("v"))


_PLACE = ", ".join(f"'{w}'" for w in text.PLACEHOLDERS)
_RAW = "CASE o_orderkey % 9 WHEN 0 THEN ' n/a ' WHEN 1 THEN 'tbd' WHEN 2 THEN '' WHEN 3 THEN 'unk' WHEN 4 THEN '0' WHEN 5 THEN '?' WHEN 6 THEN '.' ELSE o_orderpriority END"


@query("f13_placeholder", f"SELECT o_orderkey, CASE WHEN upper(trim(v)) IN ({_PLACE}) THEN '' ELSE trim(v) END AS v FROM (SELECT o_orderkey, {_RAW} AS v FROM orders)")
def f13_placeholder(spark, sf_dir):
    m = F.col("o_orderkey") % 9
    v = F.when(m == 0, " n/a ").when(m == 1, "tbd").when(m == 2, "").when(m == 3, "unk").when(m == 4, "0").when(m == 5, "?").when(m == 6, ".").otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.clean_placeholder(v).alias("v"))


_LINES = ["PO Box 12", "{k} Main St", "Box 7", "First and Oak", "", "In the Long County", "Sec 4 T12N", "2 miles north of town", "Old Mill Road", "Unit 4 Post Office Box 9"]
_LINE = "CASE o_orderkey % 10 " + " ".join(f"WHEN {i} THEN " + ("o_orderkey || ' Main St'" if "{k}" in x else f"'{x}'") for i, x in enumerate(_LINES)) + " END"


def _class_sql(u: str) -> str:
    rules = [("po_box", text.PO_BOX), ("county_only", text.COUNTY_ONLY), ("plss", text.SECTION), ("descriptive", text.DESCRIPTIVE), ("intersection", text.INTERSECTION), ("street_number", text.STREET_NUMBER)]
    return f"CASE WHEN {u} = '' THEN 'missing' " + " ".join("WHEN regexp_matches({u}, '{p}') THEN '{n}'".format(u=u, p=p.replace("'", "''"), n=n) for n, p in rules) + " ELSE 'road_no_number' END"


def _line(key, shift=0):
    out = F.lit(None)
    for i, x in enumerate(_LINES):
        out = F.when((key + shift) % 10 == i, F.concat(key.cast("string"), F.lit(" Main St")) if "{k}" in x else F.lit(x)).otherwise(out)
    return out


@query("f14_address_class", f"SELECT o_orderkey, {_class_sql('u')} AS cls FROM (SELECT o_orderkey, upper({_LINE}) AS u FROM orders)")
def f14_address_class(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", text.address_class(_line(F.col("o_orderkey"))).alias("cls"))


_LINE2 = _LINE.replace("o_orderkey % 10", "(o_orderkey + o_custkey) % 10")
_RANK = "coalesce(nullif(list_position(['street_number', 'intersection', 'road_no_number', 'descriptive', 'plss'], {c}), 0), 99)"


@query(
    "f15_pick_street",
    f"""WITH l AS (SELECT o_orderkey, {_LINE} AS a, {_LINE2} AS b FROM orders), c AS (SELECT *, {_class_sql('upper(a)')} AS ca, {_class_sql('upper(b)')} AS cb FROM l),
    r AS (SELECT *, {_RANK.format(c='ca')} AS ra, {_RANK.format(c='cb')} AS rb, upper(a) = upper(b) AS same FROM c), p AS (SELECT *, ra <= CASE WHEN same THEN 99 ELSE rb END AND ra < 99 AS one, NOT same AND rb < ra AND rb < 99 AS two FROM r)
    SELECT o_orderkey, CASE WHEN one THEN a WHEN two THEN b ELSE '' END AS street, CASE WHEN one AND NOT same AND rb < 99 THEN b WHEN two AND ra < 99 THEN a ELSE '' END AS other, CASE WHEN ca = 'po_box' THEN a WHEN cb = 'po_box' THEN b ELSE '' END AS po_box FROM p""",
)
def f15_pick_street(spark, sf_dir):
    k = F.col("o_orderkey")
    second = F.lit(None)
    for i, x in enumerate(_LINES):
        second = F.when((k + F.col("o_custkey")) % 10 == i, F.concat(k.cast("string"), F.lit(" Main St")) if "{k}" in x else F.lit(x)).otherwise(second)
    return table(spark, sf_dir, "orders").select("o_orderkey", text.pick_street(_line(k), second).alias("p")).select("o_orderkey", "p.*")


@query(
    "f17_address_flags",
    f"""SELECT c_custkey, CASE WHEN city = '' AND zip = '' THEN 'none' WHEN cls = 'street_number' THEN 'address' WHEN cls IN ('road_no_number', 'intersection') THEN 'street' ELSE 'locality' END AS prec, regexp_matches(upper(a), '{text.CIVIC}') AS civic, upper(a) || '|' || upper(city) || '|' || zip AS k
    FROM (SELECT *, {_class_sql('upper(a)')} AS cls FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_custkey || ' Elm St' WHEN 1 THEN 'City Hall' WHEN 2 THEN 'Elm and Oak' WHEN 3 THEN 'near the dam' ELSE '' END AS a, CASE c_custkey % 3 WHEN 0 THEN '' ELSE c_mktsegment END AS city, CASE c_custkey % 2 WHEN 0 THEN '' ELSE '12345' END AS zip FROM customer))""",
)
def f17_address_flags(spark, sf_dir):
    k = F.col("c_custkey")
    a = F.when(k % 5 == 0, F.concat(k.cast("string"), F.lit(" Elm St"))).when(k % 5 == 1, "City Hall").when(k % 5 == 2, "Elm and Oak").when(k % 5 == 3, "near the dam").otherwise("")
    city, zip_ = F.when(k % 3 == 0, "").otherwise(F.col("c_mktsegment")), F.when(k % 2 == 0, "").otherwise("12345")
    return table(spark, sf_dir, "customer").select("c_custkey", text.expected_precision(text.address_class(a), city, zip_).alias("prec"), text.civic(a).alias("civic"), text.address_key(a, city, zip_).alias("k"))


@query("f6_geo_terms", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE contains(lower(s_name || ' of ' || n_name), lower(CASE s_suppkey % 3 WHEN 1 THEN n_name ELSE 'Atlantis (north)' END)) END AS hit FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def f6_geo_terms(spark, sf_dir):
    """Each row's own literal term: null where it has none."""
    d = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    term = F.when(F.col("s_suppkey") % 3 == 1, F.col("n_name")).when(F.col("s_suppkey") % 3 == 2, "Atlantis (north)")
    return d.select("s_suppkey", text.mentions(F.concat_ws(" of ", "s_name", "n_name"), term).alias("hit"))


@query("f10_raw_tokens", "SELECT p_partkey, array_to_string(list_filter(regexp_split_to_array(replace(lower(p_type || ' & ' || p_brand), '&', ''), '[^a-z0-9]+'), lambda x: x <> ''), ',') AS t FROM part")
def f10_raw_tokens(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.raw_tokens(F.concat_ws(" & ", "p_type", "p_brand")), ",").alias("t"))


@query(
    "f11_acronyms",
    "SELECT a, b, regexp_full_match(a, '[a-z]{3,7}') AND length(b) >= 3 AND (CASE WHEN length(a) <= length(b) THEN starts_with(b, a) OR ends_with(b, a) ELSE starts_with(a, b) OR ends_with(a, b) END) AS hit FROM (SELECT DISTINCT lower(p_type) AS a FROM part), (SELECT unnest(['sma', 'lar', 'ard', 'eco', 'ab', 'promotional', 'standardx']) AS b)",
)
def f11_acronyms(spark, sf_dir):
    a = table(spark, sf_dir, "part").select(F.lower("p_type").alias("a")).distinct()
    b = F.explode(F.array(*[F.lit(x) for x in ("sma", "lar", "ard", "eco", "ab", "promotional", "standardx")])).alias("b")
    return a.select("a", b).select("a", "b", text.acronym_hit(F.col("a"), F.col("b")).alias("hit"))


@query(
    "f8_distinctive",
    f"SELECT p_partkey, array_to_string(list_filter(t, lambda x, i: list_position(t, x) = i), ' ') AS d FROM (SELECT p_partkey, list_filter(string_split(trim(regexp_replace(lower(p_name || ' of the Old ' || p_name || ' 12 plant'), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: length(x) >= 2 AND NOT regexp_matches(x, '^[0-9]+$') AND x NOT IN ({', '.join(repr(w) for w in text.GENERIC)})) AS t FROM part)",
)
def f8_distinctive(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.distinctive(F.concat(F.col("p_name"), F.lit(" of the Old "), F.col("p_name"), F.lit(" 12 plant"))), " ").alias("d"))


@query(
    "f19_tile_names",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN lpad(o_orderkey::VARCHAR, 11, '0') || CASE WHEN o_orderkey % 3 = 1 THEN '_500m' ELSE '_r01_c02' END END AS stem, CASE WHEN o_orderkey % 3 < 2 THEN lpad(o_orderkey::VARCHAR, 11, '0') END AS site FROM orders",
)
def f19_tile_names(spark, sf_dir):
    k = F.col("o_orderkey")
    plant = F.lpad(k.cast("string"), 11, "0")
    name = F.when(k % 3 == 0, F.concat(F.lit("0a1b2c3d-"), plant, F.lit("_r01_c02_rgb.txt"))).when(k % 3 == 1, F.concat(plant, F.lit("_500m_rgb.txt"))).otherwise(F.concat(F.lit("x"), plant, F.lit(".txt")))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.tile_name(name).alias("t")).select("o_orderkey", "t.stem", "t.site")


@query("f28_pixels", "SELECT l_orderkey, l_linenumber, l_partkey, round(-100 + l_quantity / 640.0 * 0.5, 9) AS lon, round(41 - l_linenumber / 480.0 * 0.25, 9) AS lat FROM lineitem")
def f28_pixels(spark, sf_dir):
    x, y = geo.pixel_lonlat(F.col("l_quantity"), F.col("l_linenumber"), F.lit(-100.0), F.lit(40.75), F.lit(-99.5), F.lit(41.0), 640, 480)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(x, 9).alias("lon"), F.round(y, 9).alias("lat"))


_CLIP = "greatest(0.0, least(640.0, {v}))"


@query("f29_box_remap", f"SELECT p_partkey, x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1 FROM (SELECT p_partkey, {_CLIP.format(v='p_partkey % 900 - 150.0')} AS x0, {_CLIP.format(v='p_partkey % 700 - 100.0')} AS y0, {_CLIP.format(v='p_partkey % 900 + p_size - 150.0')} AS x1, {_CLIP.format(v='p_partkey % 700 + p_size - 100.0')} AS y1 FROM part) WHERE x1 - x0 >= 2 AND y1 - y0 >= 2")
def f29_box_remap(spark, sf_dir):
    x, y = (F.col("p_partkey") % 900).cast("double"), (F.col("p_partkey") % 700).cast("double")
    box = geo.remap_box((x, y, x + F.col("p_size"), y + F.col("p_size")), F.lit(150.0), F.lit(100.0), 640, 640)
    return table(spark, sf_dir, "part").select("p_partkey", box.alias("b")).where("b is not null").select("p_partkey", "b.*")


@query("f30_box_iou", "SELECT p_partkey, round(CASE WHEN w > 0 AND h > 0 THEN w * h / (p_size * 10.0 + 400 - w * h) ELSE 0 END, 9) AS iou FROM (SELECT p_partkey, p_size, least(p_partkey % 30 + p_size, 20.0) - greatest(p_partkey % 30, 0.0) AS w, least(15.0, 20.0) - greatest(5.0, 0.0) AS h FROM part)")
def f30_box_iou(spark, sf_dir):
    x = (F.col("p_partkey") % 30).cast("double")
    iou = geo.box_iou((x, F.lit(5.0), x + F.col("p_size"), F.lit(15.0)), (F.lit(0.0), F.lit(0.0), F.lit(20.0), F.lit(20.0)))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(iou, 9).alias("iou"))


@query("f33_manifest_checksum", "SELECT o_custkey, sha256(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey::VARCHAR)) AS sum FROM orders GROUP BY 1")
def f33_manifest_checksum(spark, sf_dir):
    """SHA-256 of a manifest's sorted ids (one customer's orders)."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.col("o_orderkey").cast("string"))), ","), 256).alias("sum"))


@query("f34_dhash", "SELECT vec_id, array_to_string(list_transform(list_filter(range(0, 63), lambda i: (i + 1) % 9 <> 0), lambda i: CASE WHEN embedding[i + 2] > embedding[i + 1] THEN '1' ELSE '0' END), '') AS h FROM embeddings")
def f34_dhash(spark, sf_dir):
    """Difference hash of the first 64 values as a grid 9 wide."""
    return table(spark, sf_dir, "embeddings").select("vec_id", text.dhash(F.slice("embedding", 1, 64), 9).alias("h"))


@query("f35_label_signature", "SELECT l_orderkey, string_agg(v, ';' ORDER BY v) AS sig FROM (SELECT l_orderkey, l_linenumber || ' ' || printf('%.4f', round(l_discount / 3, 4)) || ' ' || printf('%.4f', round(l_tax / 7, 4)) AS v FROM lineitem) GROUP BY 1")
def f35_label_signature(spark, sf_dir):
    """Boxes rounded to four places and sorted: one text whatever their order."""
    box = F.format_string("%d %.4f %.4f", F.col("l_linenumber"), F.round(F.col("l_discount") / 3, 4), F.round(F.col("l_tax") / 7, 4))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(text.signature(F.collect_list(box)).alias("sig"))


@query("f39_log_ends", "SELECT doc_id, md5(CASE WHEN length(t) <= 300 THEN t ELSE substr(t, 1, 200) || chr(10) || '...' || chr(10) || right(t, 100) END) AS h FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)")
def f39_log_ends(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.keep_ends(F.col("text"), 200, 100)).alias("h"))


_NAMES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in text.SOURCE_NAMES.items())


@query(
    "f41_source_category",
    f"""WITH s AS (SELECT l_orderkey, list_sort(list_distinct(list(['cwns_point', 'cwns_addr', 'icis_fac_frs', 'icis_fac_addr', 'icis_feat_INF', 'icis_feat_INO'][1 + l_linenumber % 6]))) AS s FROM lineitem GROUP BY 1),
    c AS (SELECT l_orderkey, s, list_distinct(list_transform(s, lambda x: CASE x {_NAMES} END)) AS c FROM s)
    SELECT l_orderkey, CASE WHEN s = ['cwns_addr', 'icis_fac_addr'] THEN 'Both address geocodes (same point)' WHEN len(c) = 1 THEN c[1] ELSE 'Tie: several sources' END AS cat FROM c""",
)
def f41_source_category(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in text.SOURCE_NAMES])
    d = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set(F.get(names, F.col("l_linenumber") % 6))), "+").alias("s"))
    return d.select("l_orderkey", text.source_category(F.col("s")).alias("cat"))


@query("f16_zip5", "SELECT c_custkey, CASE WHEN len(d) >= 5 THEN substr(d, 1, 5) ELSE '' END AS zip FROM (SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS d FROM customer)")
def f16_zip5(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.zip5(F.col("c_name")).alias("zip"))


@query("f18_layer_dates", "SELECT o_orderkey, try_strptime(regexp_extract('master_' || strftime(o_orderdate, '%Y%m%d') || '_v2', '([0-9]{8})', 1), '%Y%m%d')::DATE::VARCHAR AS d FROM orders")
def f18_layer_dates(spark, sf_dir):
    name = F.concat(F.lit("master_"), F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyyMMdd"), F.lit("_v2"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.try_to_date(F.regexp_extract(name, "([0-9]{8})", 1), "yyyyMMdd").cast("string").alias("d"))


@query("f23_haversine", f"SELECT c_custkey, round(2 * 6371.0088 * asin(sqrt(pow(sin(radians({LAT.format(k='c_custkey')} - 39) / 2), 2) + cos(radians(39)) * cos(radians({LAT.format(k='c_custkey')})) * pow(sin(radians({LON.format(k='c_custkey')} + 98) / 2), 2))), 3) AS km FROM customer")
def f23_haversine(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(geo.haversine_m(F.lit(39.0), F.lit(-98.0), lat(k), lon(k)) / 1000, 3).alias("km"))


@query("f24_equirectangular", f"SELECT c_custkey, round(sqrt(pow(({LON.format(k='c_custkey')} + 98) * 111320 * cos(radians((39 + {LAT.format(k='c_custkey')}) / 2)), 2) + pow(({LAT.format(k='c_custkey')} - 39) * 111320, 2)) / 1000, 3) AS km FROM customer")
def f24_equirectangular(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(geo.equirectangular_m(F.lit(39.0), F.lit(-98.0), lat(k), lon(k)) / 1000, 3).alias("km"))


@query("f25_albers", f"SELECT c_custkey, round({LAT.format(k='c_custkey')}, 7) AS lat, round({LON.format(k='c_custkey')}, 7) AS lon, true AS same FROM customer")
def f25_albers(spark, sf_dir):
    """Forward and inverse: the way there and back gives the point again (the forward one is held against published values in a test)."""
    k = F.col("c_custkey")
    x, y = geo.albers_xy(lat(k), lon(k))
    d = table(spark, sf_dir, "customer").select("c_custkey", x.alias("x"), y.alias("y"), lat(k).alias("la"), lon(k).alias("lo"))
    la, lo = geo.albers_latlon(F.col("x"), F.col("y"))
    return d.select("c_custkey", F.round(la, 7).alias("lat"), F.round(lo, 7).alias("lon"), ((F.abs(la - F.col("la")) < 1e-9) & (F.abs(lo - F.col("lo")) < 1e-9)).alias("same"))


@query("f27_rings", "SELECT o_orderkey, floor(o_totalprice / 330)::BIGINT AS ring, o_totalprice <= 1000 AS within_1km, o_totalprice <= 5000 AS within_5km FROM orders")
def f27_rings(spark, sf_dir):
    t = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.floor(t / 330).alias("ring"), (t <= 1000).alias("within_1km"), (t <= 5000).alias("within_5km"))


@query("f31_hash_split", "SELECT doc_id, ('0x' || substr(sha1(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < 0.2 AS val FROM documents")
def f31_hash_split(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", (text.hash_fraction(F.col("doc_id")) < 0.2).alias("val"))


@query("f32_hash_seed", "SELECT n_name, ('0x' || substr(sha256(n_name), 1, 8))::BIGINT % 10000 AS seed FROM nation")
def f32_hash_seed(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_name", text.hash_seed(F.col("n_name")).alias("seed"))


@query("f34_content_hash", "SELECT md5(text) AS h, count(*) AS n, min(doc_id) AS keeper FROM documents GROUP BY 1 HAVING count(*) > 1")
def f34_content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keeper")).where("n > 1")


@query("f36_bins", "SELECT p_partkey, CASE WHEN p_size <= 10 THEN '(0, 10]' WHEN p_size <= 25 THEN '(10, 25]' ELSE '(25, 50]' END AS bin FROM part WHERE p_size > 0 AND p_size <= 50")
def f36_bins(spark, sf_dir):
    s = F.col("p_size")
    return table(spark, sf_dir, "part").where((s > 0) & (s <= 50)).select("p_partkey", F.when(s <= 10, "(0, 10]").when(s <= 25, "(10, 25]").otherwise("(25, 50]").alias("bin"))


@query("f37_error_canonical", "SELECT m, count(*) AS n FROM (SELECT substr(regexp_replace(regexp_replace(url, 'https?://[^ ]+/', '<url>', 'g'), '[0-9]+', 'N', 'g'), 1, 110) AS m FROM pages) GROUP BY 1")
def f37_error_canonical(spark, sf_dir):
    m = F.substring(F.regexp_replace(F.regexp_replace("url", "https?://[^ ]+/", "<url>"), "[0-9]+", "N"), 1, 110)
    return table(spark, sf_dir, "pages").groupBy(m.alias("m")).agg(F.count(F.lit(1)).alias("n"))


@query("f38_transient", "SELECT o_orderkey, regexp_matches('status ' || (o_orderkey % 600), '\\b(429|503|504)\\b') AS again FROM orders")
def f38_transient(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("status "), (F.col("o_orderkey") % 600).cast("string")).rlike(r"\b(429|503|504)\b").alias("again"))


@query("f40_arrays", "SELECT l_orderkey, count(*) AS n, list_contains(list(l_linenumber), 3) AS has3, array_to_string(list_sort(list_distinct(list(l_returnflag))), ';') AS flags FROM lineitem GROUP BY 1")
def f40_arrays(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.size(F.collect_list("l_partkey")).cast("bigint").alias("n"), F.array_contains(F.collect_set("l_linenumber"), 3).alias("has3"), F.array_join(F.array_sort(F.collect_set("l_returnflag")), ";").alias("flags"))


@query("f42_round_half_even", "SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 2, 0) AS h FROM lineitem")
def f42_round_half_even(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.bround(F.col("l_quantity") / 2, 0).alias("h"))


@query("f43_overwrite", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END, o_custkey::DOUBLE) AS v FROM orders")
def f43_overwrite(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")), F.col("o_custkey").cast("double")).alias("v"))


@query("f44_json", "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1")
def f44_json(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("f20_indel_ratio")
def f20_indel_ratio(spark, sf_dir):
    """Names of parts against their brand and type: distinct pairs are scored once."""
    p = table(spark, sf_dir, "part").select(F.lower("p_name").alias("a"), F.lower("p_type").alias("b")).distinct()
    return p.select("a", "b", F.round(text.indel_ratio("a", "b"), 6).alias("ratio"))


@query(
    "f21_cosine",
    "WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 20 = 0) SELECT a.vec_id AS q, b.vec_id AS v, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS sim FROM q a JOIN embeddings b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > 0.3",
)
def f21_cosine(spark, sf_dir):
    """Cosine of a stated query set (every 20th vector) against all vectors, block by block."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.similar(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", 0.3).select("q", "v", F.round("sim", 6).alias("sim"))


_GRAMS = "list_distinct(flatten(list_transform([3, 4, 5], lambda n: list_transform(range(0, greatest(0, length(v) - n + 1)), lambda i: substr(v, i + 1, n)))))"


@query(
    "f21_char_ngrams",
    f"""WITH n AS (SELECT p_brand AS k, min(lower(p_name)) AS v FROM part GROUP BY 1), g AS (SELECT k, unnest({_GRAMS}) AS g FROM n), t AS (SELECT count(*) AS n FROM n), w AS (SELECT g, ln((1.0 + max(t.n)) / (1 + count(*))) + 1 AS w FROM g, t GROUP BY 1),
    z AS (SELECT k, sqrt(sum(w * w)) AS z FROM g JOIN w USING (g) GROUP BY 1), d AS (SELECT a.k AS a, b.k AS b, sum(w * w) AS d FROM g a JOIN g b USING (g) JOIN w USING (g) WHERE a.k < b.k GROUP BY 1, 2)
    SELECT a, b, round(d / x.z / y.z, 6) AS sim FROM d JOIN z x ON x.k = a JOIN z y ON y.k = b""",
)
def f21_char_ngrams(spark, sf_dir):
    """TF-IDF cosine of names' distinct character 3- to 5-grams, through an inverted index."""
    n = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("k")).agg(F.min(F.lower("p_name")).alias("v"))
    return vectors.ngram_cosine(n, "k", "v").select("a", "b", F.round("sim", 6).alias("sim"))
