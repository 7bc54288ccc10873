"""Decisions on plants: cascades, outcome classes, verdicts, bins, gates. The driver's tables stand in for plants, candidates and reviews."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.functions import text
from siteforge.operators import audit, metrics, names, outcomes, ranking, sampling
from siteforge.plans.points import LAT, LON, hav, lat, lon
from siteforge.plans.registry import query
from siteforge.sources.tables import table

_TIER = "CASE WHEN status IN ('verified_correct', 'verified_corrected') THEN 'verified' WHEN status IN ('moved', 'kept_site', 'kept_model', 'kept_osm', 'flagged_not_moved') THEN CASE WHEN pop_band IS DISTINCT FROM '>1k' THEN 'model_small_plant' ELSE 'model' END ELSE 'none' END"
_BASIS = """CASE WHEN status = 'moved' THEN CASE move_path WHEN 'stage1_seed' THEN 'stage1_accept_seed' WHEN 'stage2' THEN 'stage2_move' END WHEN status IN ('verified_correct', 'verified_corrected', 'reviewed_unresolved') THEN 'reviewer'
    WHEN status IN ('kept_model', 'kept_osm') THEN 'stage1_accept' ELSE status END"""
#: A master and its scored plants from the orders.
_PLANTS = f"""(SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 < 2 THEN 'Yes' WHEN o_orderkey % 5 = 2 THEN 'No' END AS verified, CASE o_orderkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN CASE WHEN o_custkey % 2 = 0 THEN 'No' END END AS oc,
    CASE WHEN o_custkey % 3 > 0 THEN {LON.format(k='o_custkey')} END AS cx, CASE WHEN o_custkey % 3 > 0 THEN {LAT.format(k='o_custkey')} END AS cy, CASE WHEN o_custkey % 2 = 0 THEN 'manual' END AS how,
    CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'osm_confirmed' WHEN 2 THEN 'no_parcel' ELSE 'model' END AS route, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'none' WHEN 2 THEN 'no_parcel' WHEN 3 THEN 'none' ELSE 'low_confidence' END AS trigger,
    CASE WHEN o_orderkey % 7 IN (1, 3) THEN CASE WHEN o_custkey % 2 = 0 THEN 'cwns_point+icis_fac_frs' ELSE 'icis_fac_frs' END END AS accepted, CASE WHEN o_custkey % 4 > 0 THEN 'p' || o_custkey END AS top, o_totalprice / 500000 AS score, o_custkey % 5 = 0 AS fallback,
    CASE WHEN o_custkey % 6 > 0 THEN {LAT.format(k='(o_custkey + 7)')} END AS tla, CASE WHEN o_custkey % 6 > 0 THEN {LON.format(k='(o_custkey + 7)')} END AS tlo, o_custkey % 8 = 1 AS inside, CASE WHEN o_custkey % 9 > 0 THEN {LAT.format(k='o_orderkey')} END AS la, {LON.format(k='o_orderkey')} AS lo,
    o_custkey % 10 > 1 AS scored, o_custkey % 11 > 2 AS pop, CASE o_custkey % 3 WHEN 0 THEN '>1k' WHEN 1 THEN '100-1k' END AS pop_band FROM orders)"""


def plants(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    m5, m7 = k % 5, k % 7
    return table(spark, sf_dir, "orders").select(
        k.alias("k"), F.when(m5 < 2, "Yes").when(m5 == 2, "No").alias("Verified"), F.when(m5 == 0, "Yes").when(m5 == 1, "No").when((m5 == 2) & (c % 2 == 0), "No").alias("Original_Correct"), F.when(c % 3 > 0, lon(c)).alias("Corrected_X"),
        F.when(c % 3 > 0, lat(c)).alias("Corrected_Y"), F.when(c % 2 == 0, "manual").alias("How_Corrected"), F.when(m7 == 1, "osm_confirmed").when(m7 == 2, "no_parcel").when(m7 > 2, "model").alias("route"),
        F.when(m7.isin(1, 3), "none").when(m7 == 2, "no_parcel").when(m7 > 3, "low_confidence").alias("trigger_reason"), F.when(m7.isin(1, 3), F.when(c % 2 == 0, "cwns_point+icis_fac_frs").otherwise("icis_fac_frs")).alias("accepted_sources"),
        F.when(c % 4 > 0, F.concat(F.lit("p"), c.cast("string"))).alias("top"), (F.col("o_totalprice") / 500000).alias("top_score"), (c % 5 == 0).alias("fallback"), F.when(c % 6 > 0, lat(c + 7)).alias("top_lat"), F.when(c % 6 > 0, lon(c + 7)).alias("top_lon"),
        (c % 8 == 1).alias("reported_in_site"), F.when(c % 9 > 0, lat(k)).alias("reported_lat"), lon(k).alias("reported_lon"), (c % 10 > 1).alias("state_scored"), (c % 11 > 2).alias("pop_ok"), F.when(c % 3 == 0, ">1k").when(c % 3 == 1, "100-1k").alias("pop_band"),
    )


@query(
    "c11_final_output",
    f"""WITH p AS (SELECT *, trigger IN ('low_confidence', 'no_parcel') AS flagged, route IS NOT NULL AND trigger = 'none' AND accepted IS NOT NULL AND NOT contains(accepted, 'cwns_point') AS seed FROM {_PLANTS}),
    c AS (SELECT *, coalesce(flagged, false) AND top IS NOT NULL AND score >= 0.4 AS can FROM p),
    s AS (SELECT *, CASE WHEN verified = 'Yes' AND oc = 'Yes' THEN 'verified_correct' WHEN verified = 'Yes' AND oc = 'No' AND cx IS NOT NULL THEN 'verified_corrected' WHEN oc = 'No' THEN 'reviewed_unresolved' WHEN route IS NULL THEN 'not_assessed'
      WHEN seed AND tla IS NOT NULL THEN 'moved' WHEN seed THEN 'kept_model' WHEN route = 'osm_confirmed' THEN 'kept_osm' WHEN trigger = 'none' THEN 'kept_model' WHEN can AND tla IS NULL THEN 'flagged_not_moved' WHEN can AND inside THEN 'kept_site' WHEN can THEN 'moved' WHEN flagged THEN 'flagged_not_moved' ELSE 'not_assessed' END AS status FROM c),
    r AS (SELECT *, CASE WHEN status = 'verified_correct' THEN '' WHEN status = 'verified_corrected' THEN coalesce(how, '') WHEN status = 'reviewed_unresolved' THEN '' WHEN route IS NULL THEN CASE WHEN la IS NULL THEN 'no_coordinates' WHEN NOT scored THEN 'no_imagery_state' WHEN NOT pop THEN 'population_low_or_unknown' ELSE 'not_scored' END
      WHEN seed AND tla IS NOT NULL THEN 'accepted site does not hold the reported point' WHEN seed THEN 'seed_site_not_placed' WHEN route = 'osm_confirmed' OR trigger = 'none' THEN '' WHEN can AND tla IS NULL THEN 'move_parcel_not_found' WHEN can AND inside THEN 'reported parcel is part of the first site' WHEN can THEN '' ELSE trigger END AS status_reason,
      CASE WHEN status NOT IN ('moved', 'kept_site') THEN '' WHEN seed THEN 'stage1_seed' ELSE 'stage2' END AS move_path,
      CASE status WHEN 'verified_corrected' THEN cy WHEN 'moved' THEN tla ELSE la END AS ola, CASE status WHEN 'verified_corrected' THEN cx WHEN 'moved' THEN tlo ELSE lo END AS olo FROM s)
    SELECT k, status, status_reason, move_path, round(ola, 9) AS out_lat, round(olo, 9) AS out_lon, round(CASE WHEN status IN ('moved', 'verified_corrected') THEN {hav('la', 'lo', 'ola', 'olo')} ELSE 0 END / 1000, 3) AS moved_km, {_BASIS} AS loc_basis, {_TIER} AS confidence_tier FROM r""",
)
def c11_final_output(spark, sf_dir):
    """Statuses with reasons, placed points, basis and tier (P10 to P13, C11)."""
    d = outcomes.corrected_output(plants(spark, sf_dir), 0.4)
    return d.select("k", "status", "status_reason", "move_path", F.round("out_lat", 9).alias("out_lat"), F.round("out_lon", 9).alias("out_lon"), F.round(F.col("moved_m") / 1000, 3).alias("moved_km"), "loc_basis", "confidence_tier")


@query("p10_ordered_cascade", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 40 THEN 'big' WHEN l_discount > 0.05 THEN 'cheap' WHEN l_tax > 0.06 THEN 'taxed' ELSE 'plain' END AS c FROM lineitem")
def p10_ordered_cascade(spark, sf_dir):
    c = outcomes.cascade([(F.col("l_quantity") > 40, "big"), (F.col("l_discount") > 0.05, "cheap"), (F.col("l_tax") > 0.06, "taxed")], "plain")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", c.alias("c"))


_STATUS = "(SELECT o_orderkey AS k, ['verified_correct', 'verified_corrected', 'moved', 'kept_site', 'kept_model', 'kept_osm', 'flagged_not_moved', 'reviewed_unresolved', 'not_assessed'][1 + o_orderkey % 9] AS status, CASE o_custkey % 3 WHEN 0 THEN '>1k' WHEN 1 THEN '100-1k' END AS pop_band, CASE o_custkey % 2 WHEN 0 THEN 'stage2' ELSE 'stage1_seed' END AS move_path FROM orders)"


def _statuses(spark, sf_dir):
    names_ = F.array(*[F.lit(x) for x in ("verified_correct", "verified_corrected", "moved", "kept_site", "kept_model", "kept_osm", "flagged_not_moved", "reviewed_unresolved", "not_assessed")])
    c = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.get(names_, (F.col("o_orderkey") % 9).cast("int")).alias("status"), F.when(c % 3 == 0, ">1k").when(c % 3 == 1, "100-1k").alias("pop_band"), F.when(c % 2 == 0, "stage2").otherwise("stage1_seed").alias("move_path"))


@query("p12_confidence_tier", f"SELECT k, {_TIER} AS tier FROM {_STATUS}")
def p12_confidence_tier(spark, sf_dir):
    return _statuses(spark, sf_dir).select("k", outcomes.confidence_tier(F.col("status"), F.col("pop_band")).alias("tier"))


@query("p13_location_basis", f"SELECT k, {_BASIS} AS basis FROM {_STATUS}")
def p13_location_basis(spark, sf_dir):
    return _statuses(spark, sf_dir).select("k", outcomes.location_basis(F.col("status"), F.col("move_path")).alias("basis"))


@query(
    "p14_holdout_outcome",
    """WITH s AS (SELECT l_orderkey AS k, list(l_partkey) AS site, min(l_partkey) AS rep, max(l_partkey) AS top, count(*) AS n FROM lineitem GROUP BY 1), h AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_custkey % 2000 END AS truth FROM orders)
    SELECT h.k, CASE WHEN s.k IS NULL THEN 'not_scored' WHEN truth IS NULL THEN 'truth_unresolved' WHEN n % 2 = 0 THEN CASE WHEN list_contains(site, truth) THEN 'accepted_right' ELSE 'accepted_wrong' END WHEN top = truth THEN 'moved_right' ELSE 'flagged_wrong' END AS outcome FROM h LEFT JOIN s USING (k)""",
)
def p14_holdout_outcome(spark, sf_dir):
    s = lambda c: c.cast("string")
    g = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(s(F.col("l_partkey"))).alias("site"), s(F.min("l_partkey")).alias("rep"), s(F.max("l_partkey")).alias("top"), F.count(F.lit(1)).alias("n"))
    h = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 6 != 0, s(F.col("o_custkey") % 2000)).alias("truth"))
    trigger = F.when(F.col("n") % 2 == 0, "none").otherwise("low_confidence")
    return h.join(g, "k", "left").select("k", outcomes.holdout_outcome(F.col("n").isNotNull(), F.col("truth"), trigger, F.col("site"), F.col("rep"), F.col("top")).alias("outcome"))


_VERDICT = "['reported_correct', 'candidate_correct', 'truth_outside_candidates', 'needs_info'][1 + {k} % 4]"


def _verdict(k):
    return F.get(F.array(*[F.lit(x) for x in ("reported_correct", "candidate_correct", "truth_outside_candidates", "needs_info")]), (k % 4).cast("int"))


@query(
    "p15_review_outcome",
    f"""SELECT k, CASE WHEN v IN ('candidate_correct', 'reported_correct') AND site <> '' AND list_contains(string_split(site, ';'), top) THEN 'right' WHEN v = 'reported_correct' THEN 'false_move' WHEN v = 'truth_outside_candidates' THEN 'truth_outside' WHEN v = 'candidate_correct' AND r = 1 THEN 'right' WHEN v = 'candidate_correct' THEN 'wrong_candidate' ELSE 'needs_info' END AS outcome
    FROM (SELECT o_orderkey AS k, {_VERDICT.format(k='o_orderkey')} AS v, o_custkey % 3 AS r, CASE WHEN o_custkey % 5 = 0 THEN 'a;b;c' ELSE '' END AS site, ['a', 'b', 'z'][1 + o_custkey % 3] AS top FROM orders)""",
)
def p15_review_outcome(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    top = F.get(F.array(F.lit("a"), F.lit("b"), F.lit("z")), (c % 3).cast("int"))
    return table(spark, sf_dir, "orders").select(k.alias("k"), outcomes.review_outcome(_verdict(k), c % 3, F.when(c % 5 == 0, "a;b;c").otherwise(""), top).alias("outcome"))


@query(
    "p16_coverage_cause",
    "SELECT k, CASE WHEN p IS NULL THEN 'b_no_parcel_at_corrected_point' WHEN f THEN 'ok_usable' WHEN r THEN 'd_lost_in_02_join' WHEN NOT ring AND NOT win THEN 'a_outside_search_window' ELSE 'c_in_window_but_no_nlcd_row' END AS cause FROM (SELECT o_orderkey AS k, nullif(o_custkey % 7, 0) AS p, o_custkey % 2 = 0 AS f, o_custkey % 3 = 0 AS r, o_custkey % 5 < 2 AS ring, o_custkey % 11 < 2 AS win FROM orders)",
)
def p16_coverage_cause(spark, sf_dir):
    c = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), outcomes.coverage_cause(F.nullif(c % 7, F.lit(0)), c % 2 == 0, c % 3 == 0, c % 5 < 2, c % 11 < 2).alias("cause"))


_CATS = ", ".join(f"'{c}'" for c in outcomes.SEWER_CATEGORIES)
_LARGE = ", ".join(f"'{c}'" for c in outcomes.LARGE_CATEGORIES)


@query(
    "c16_permit_universe",
    f"""WITH p AS (SELECT l_partkey AS permit, l_linenumber AS version, min(CASE WHEN l_suppkey % 3 = 0 THEN 'GPC' ELSE 'NPD' END) AS kind, min(CASE WHEN l_returnflag = 'R' THEN 'TRM' ELSE 'EFF' END) AS status, min(l_shipdate) AS expires, bool_or(l_quantity > 48) AS treatment, min(l_discount) AS flow FROM lineitem GROUP BY 1, 2),
    low AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY permit ORDER BY version) AS r FROM p) WHERE r = 1), a AS (SELECT permit, bool_or(treatment) AS any_t FROM p GROUP BY 1),
    d AS (SELECT low.permit, version, kind, flow, any_t, p_name AS facility, CASE WHEN p_size % 4 = 0 THEN NULL ELSE lpad((p_size * 3)::VARCHAR, 3, '0') END AS category, p_size % 5 = 0 AS sewerage, regexp_matches(upper(p_name || CASE WHEN p_size % 6 = 0 THEN ' Sewage works' ELSE '' END), '{outcomes.SEWER_NAMES}') AS named
      FROM low JOIN a USING (permit) JOIN part ON p_partkey = low.permit WHERE status = 'EFF' OR expires >= TIMESTAMP '1998-01-01')
    SELECT permit, version, CASE WHEN kind = 'GPC' AND category IS NOT NULL AND category NOT IN ({_CATS}) THEN 'nonsewer_category' WHEN any_t OR named THEN 'core' WHEN coalesce(category, '') IN ({_LARGE}) OR coalesce(flow, 0) >= 0.1 THEN 'code_large' ELSE 'code_household' END AS tier FROM d WHERE any_t OR named OR sewerage""",
)
def c16_permit_universe(spark, sf_dir):
    """The lowest version of each live permit, its facility, sewerage code and tier (P17, W11, A36, C16)."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("permit"), F.col("l_linenumber").alias("version")).agg(
        F.min(F.when(F.col("l_suppkey") % 3 == 0, "GPC").otherwise("NPD")).alias("kind"), F.min(F.when(F.col("l_returnflag") == "R", "TRM").otherwise("EFF")).alias("status"), F.min("l_shipdate").alias("expires"), F.bool_or(F.col("l_quantity") > 48).alias("treatment"), F.min("l_discount").alias("flow"),
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("permit"), "p_name", "p_size")
    size = F.col("p_size")
    p = li.join(part, "permit").withColumns({"ended": F.lit(None).cast("timestamp_ntz"), "retired": F.lit(None).cast("timestamp_ntz"), "name": F.lit(None).cast("string"), "category": F.when(size % 4 != 0, F.lpad((size * 3).cast("string"), 3, "0"))}).drop("p_name", "p_size")
    facilities = part.select("permit", F.concat("p_name", F.when(size % 6 == 0, " Sewage works").otherwise("")).alias("facility"))
    codes = part.select("permit", (size % 5 == 0).alias("sewerage"))
    return outcomes.permit_universe(p, facilities, codes, "1998-01-01").select("permit", "version", "tier")


@query("p17_permit_tier", f"SELECT p_partkey, CASE WHEN p_size % 3 = 0 AND c IS NOT NULL AND c NOT IN ({_CATS}) THEN 'nonsewer_category' WHEN p_size % 7 = 0 OR p_size % 11 = 0 THEN 'core' WHEN coalesce(c, '') IN ({_LARGE}) OR p_size / 300.0 >= 0.1 THEN 'code_large' ELSE 'code_household' END AS tier FROM (SELECT *, CASE WHEN p_size % 4 = 0 THEN NULL ELSE lpad((p_size * 3)::VARCHAR, 3, '0') END AS c FROM part)")
def p17_permit_tier(spark, sf_dir):
    s = F.col("p_size")
    tier = outcomes.permit_tier(F.when(s % 3 == 0, "GPC").otherwise("NPD"), F.when(s % 4 != 0, F.lpad((s * 3).cast("string"), 3, "0")), s % 7 == 0, s % 11 == 0, s / 300.0)
    return table(spark, sf_dir, "part").select("p_partkey", tier.alias("tier"))


@query(
    "p19_verdict_columns",
    f"""WITH v AS (SELECT o_orderkey AS k, {_VERDICT.format(k='o_orderkey')} AS v, CASE WHEN o_custkey % 4 = 0 THEN 'viewer' ELSE 'candidate_pick' END AS task, CASE WHEN o_custkey % 3 > 0 THEN o_custkey / 10.0 END AS x, 'r' || o_custkey AS rep, 'c' || o_custkey AS sel, CASE WHEN o_custkey % 5 = 0 THEN 'e1;r' || o_custkey || ';e2' END AS ext FROM orders),
    s AS (SELECT *, CASE WHEN ext IS NULL THEN rep ELSE rep || ';e1;e2' END AS s1, CASE WHEN ext IS NULL THEN sel ELSE sel || ';e1;' || rep || ';e2' END AS s2 FROM v)
    SELECT k, CASE WHEN v = 'reported_correct' THEN 'Yes' ELSE 'No' END AS oc, CASE WHEN v <> 'reported_correct' THEN x END AS x, CASE WHEN v = 'reported_correct' THEN NULL WHEN task = 'viewer' THEN 'viewer' WHEN v = 'candidate_correct' THEN 'model' ELSE 'manual' END AS how, CASE v WHEN 'reported_correct' THEN s1 WHEN 'candidate_correct' THEN s2 END AS site FROM s WHERE v = 'reported_correct' OR x IS NOT NULL""",
)
def p19_verdict_columns(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rep, sel = F.concat(F.lit("r"), c.cast("string")), F.concat(F.lit("c"), c.cast("string"))
    x = F.when(c % 3 > 0, c / 10.0)
    v = outcomes.verdict_columns(_verdict(k), F.when(c % 4 == 0, "viewer").otherwise("candidate_pick"), x, x, rep, sel, F.when(c % 5 == 0, F.concat(F.lit("e1;"), rep, F.lit(";e2"))))
    return table(spark, sf_dir, "orders").select(k.alias("k"), v.alias("v")).where("v is not null").select("k", F.col("v.Original_Correct").alias("oc"), F.col("v.Corrected_X").alias("x"), F.col("v.How_Corrected").alias("how"), F.col("v.Site_UUIDs").alias("site"))


@query(
    "p20_training_bins",
    f"SELECT k, unnest(list_filter([CASE WHEN coalesce(verified, 'No') <> 'Yes' THEN 'unverified' END, CASE WHEN verified = 'Yes' AND oc = 'Yes' THEN 'Correct' END, CASE WHEN verified = 'Yes' AND oc = 'No' THEN 'Incorrect' END, CASE WHEN verified = 'Yes' AND oc = 'No' AND cx IS NOT NULL THEN 'correction' END], lambda x: x IS NOT NULL)) AS bin FROM {_PLANTS} WHERE la IS NOT NULL",
)
def p20_training_bins(spark, sf_dir):
    m = plants(spark, sf_dir).withColumns({"Corrected": F.when(F.col("Corrected_X").isNotNull(), "Yes"), "Original_X": F.col("reported_lon"), "Original_Y": F.col("reported_lat")})
    return outcomes.training_bins(m, "k")


@query("p23_detection_state", "SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN 'not_evaluated' WHEN o_custkey % 4 = 1 THEN 'no_imagery' WHEN o_orderkey % 3 > 0 THEN 'detected' ELSE 'none_found' END AS s FROM orders")
def p23_detection_state(spark, sf_dir):
    c = F.col("o_custkey") % 4
    return table(spark, sf_dir, "orders").select("o_orderkey", outcomes.detection_state(F.col("o_orderkey") % 3, F.when(c != 0, True), c != 1).alias("s"))


@query("p24_prefix_fill", "SELECT o_orderkey, coalesce(CASE WHEN o_custkey % 2 = 0 THEN true END, false) AS od_has_tank, coalesce(CASE WHEN o_custkey % 3 = 0 THEN o_custkey END, 0) AS od_n_tank, CASE WHEN o_custkey % 5 = 0 THEN o_totalprice END AS od_max_conf_tank FROM orders")
def p24_prefix_fill(spark, sf_dir):
    c = F.col("o_custkey")
    d = table(spark, sf_dir, "orders").select("o_orderkey", F.when(c % 2 == 0, True).alias("od_has_tank"), F.when(c % 3 == 0, c).alias("od_n_tank"), F.when(c % 5 == 0, F.col("o_totalprice")).alias("od_max_conf_tank"))
    return outcomes.fill_by_prefix(d, {"od_has_": False, "od_n_": 0})


@query("p25_column_lists", "SELECT c_custkey, c_acctbal FROM customer")
def p25_column_lists(spark, sf_dir):
    return outcomes.kept(outcomes.without(table(spark, sf_dir, "customer"), ["c_name", "absent"]), ["c_custkey", "absent", "c_acctbal"])


@query("p26_reindex", "SELECT p_size, p_retailprice, p_partkey FROM part")
def p26_reindex(spark, sf_dir):
    return outcomes.aligned(table(spark, sf_dir, "part"), ["p_size", "p_retailprice", "p_partkey"])


@query("p27_legend", "SELECT o_orderstatus AS status, count(*) AS n, o_orderstatus IN ('F', 'P') AS shown FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_totalprice BETWEEN 20000 AND 300000 GROUP BY 1")
def p27_legend(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("state"), F.col("o_totalprice").alias("pop"), F.col("o_orderstatus").alias("status"))
    return outcomes.legend(d, ["1-URGENT", "5-LOW"], 20000, 300000, ["F", "P"])


@query(
    "p29_verdict_violations",
    f"""SELECT k, array_to_string(list_filter([CASE WHEN v = 'candidate_correct' AND (sel IS NULL OR r IS NULL) THEN 'candidate' END, CASE WHEN v = 'truth_outside_candidates' AND la IS NULL THEN 'truth' END, CASE WHEN site <> '' AND v NOT IN ('reported_correct', 'candidate_correct') THEN 'site' END, CASE WHEN v IN ('reported_correct', 'candidate_correct') AND conf IS NULL THEN 'confirmation' END], lambda x: x IS NOT NULL), ',') AS bad
    FROM (SELECT o_orderkey AS k, {_VERDICT.format(k='o_orderkey')} AS v, nullif(o_custkey % 3, 0) AS sel, nullif(o_custkey % 5, 0) AS r, nullif(o_custkey % 7, 0) AS la, CASE WHEN o_custkey % 2 = 0 THEN 'a' ELSE '' END AS site, nullif(o_custkey % 11, 0) AS conf FROM orders)""",
)
def p29_verdict_violations(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    n = lambda m: F.nullif(c % m, F.lit(0))
    bad = outcomes.verdict_violations(_verdict(k), n(3), n(5), n(7), n(7), F.when(c % 2 == 0, "a").otherwise(""), n(11))
    return table(spark, sf_dir, "orders").select(k.alias("k"), F.array_join(bad, ",").alias("bad"))


@query("p30_id_rules", "SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey::VARCHAR ELSE lpad(o_orderkey::VARCHAR, 11, '01') END AS id FROM orders) WHERE length(id) = 11 AND substr(id, 1, 2) IN ('01', '10')")
def p30_id_rules(spark, sf_dir):
    k = F.col("o_orderkey")
    i = F.when(k % 3 == 0, k.cast("string")).otherwise(F.lpad(k.cast("string"), 11, "01"))
    return table(spark, sf_dir, "orders").where(outcomes.id_valid(i, 11, ["01", "10"])).select("o_orderkey")


@query("p31_reservation", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def p31_reservation(spark, sf_dir):
    """Rows that no other round holds; one that does raises."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return outcomes.reserve(o.where("o_orderstatus = 'P'").select("o_orderkey"), o.where("o_orderstatus = 'F'").select("o_orderkey"), "o_orderkey")


_SITES = "(SELECT l_orderkey AS plant, l_linenumber AS site_rank, l_orderkey || '_s' || l_linenumber AS site_id, l_partkey AS rep, l_returnflag AS sources, l_suppkey % 3 + 1 AS n_origins, l_linenumber AS n_seeds, l_linestatus = 'F' AS pt, l_quantity / 50.0 AS prob, l_discount > 0.095 AS osm, 40 + l_suppkey / 1000.0 AS lat, -100 + l_partkey / 10000.0 AS lon FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS dup FROM lineitem) WHERE dup = 1)"


@query(
    "c5_plant_decision",
    f"""WITH s AS (SELECT * FROM {_SITES}), p AS (SELECT plant, bool_or(osm) AS any_osm, max(CASE WHEN osm THEN prob END) AS to_, max(prob) AS tp, count(*) AS n FROM s GROUP BY 1),
    nr AS (SELECT s.*, any_osm, n, row_number() OVER (PARTITION BY plant ORDER BY n_origins DESC, pt DESC, prob DESC, site_rank) AS r FROM s JOIN p USING (plant) WHERE (NOT any_osm OR osm) AND prob >= CASE WHEN any_osm THEN to_ ELSE tp END - {outcomes.SITE_TIE_MARGIN}),
    b AS (SELECT * FROM nr WHERE r = 1), al AS (SELECT s.*, row_number() OVER (PARTITION BY s.plant ORDER BY s.prob DESC, s.n_origins DESC, s.site_rank) AS r FROM s JOIN b ON b.plant = s.plant AND b.site_id <> s.site_id), a AS (SELECT * FROM al WHERE r = 1)
    SELECT o_orderkey AS plant, b.site_id AS best_site_id, CASE WHEN any_osm OR b.prob >= 0.9 THEN b.site_id END AS accepted_site_id, a.site_id AS alt_site_id, coalesce((any_osm OR b.prob >= 0.9) AND a.prob >= 0.9 AND {hav('b.lat', 'b.lon', 'a.lat', 'a.lon')} > 1000 AND abs(b.prob - a.prob) <= {outcomes.MULTI_PASS_MARGIN}, false) AS multi_pass, coalesce(n, 0) AS n_sites,
    CASE WHEN b.plant IS NULL THEN 'no_parcel' WHEN any_osm THEN 'osm_confirmed' ELSE 'model' END AS route, CASE WHEN b.plant IS NULL THEN 'no_parcel' WHEN any_osm OR b.prob >= 0.9 THEN 'none' ELSE 'low_confidence' END AS trigger_reason FROM orders LEFT JOIN b ON b.plant = o_orderkey LEFT JOIN a ON a.plant = o_orderkey""",
)
def c5_plant_decision(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    one = li.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_discount")).alias("m")).select("l_orderkey", "l_linenumber", "m.*")
    s = one.select(
        F.col("l_orderkey").alias("plant"), F.concat_ws("_s", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("site_id"), F.col("l_partkey").alias("rep"), F.col("l_returnflag").alias("sources"), (F.col("l_suppkey") % 3 + 1).alias("n_origins"), F.col("l_linenumber").alias("n_seeds"),
        (F.col("l_linestatus") == "F").alias("has_cwns_point"), F.col("l_linenumber").alias("site_rank"), (F.col("l_quantity") / 50.0).alias("prob"), (F.col("l_discount") > 0.095).alias("osm"), (40 + F.col("l_suppkey") / 1000.0).alias("lat"), (-100 + F.col("l_partkey") / 10000.0).alias("lon"),
    )
    d = outcomes.site_decision(s, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("plant")), 0.9)
    return d.select("plant", "best_site_id", "accepted_site_id", "alt_site_id", "multi_pass", "n_sites", "route", "trigger_reason")


@query("c13_reconcile", "SELECT c_custkey, 'c_mktsegment' AS col, c_mktsegment AS old, s AS new FROM customer JOIN (SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS s FROM orders WHERE o_totalprice > 100000 GROUP BY 1) ON o_custkey = c_custkey WHERE c_custkey % 3 > 0 AND s <> c_mktsegment UNION ALL SELECT c_custkey, 'unknown', NULL, NULL FROM (SELECT 1 AS c_custkey WHERE false)")
def c13_reconcile(spark, sf_dir):
    """The change log: nulls (every third customer's) never overwrite."""
    u = table(spark, sf_dir, "orders").where("o_totalprice > 100000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("c_mktsegment"))
    u = u.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")))
    _, log, _ = outcomes.reconcile(table(spark, sf_dir, "customer"), u, "c_custkey", ["c_mktsegment"])
    return log.withColumnRenamed("column", "col")


@query("c13_unknown_ids", "SELECT DISTINCT o_custkey + 1000000 AS c_custkey FROM orders WHERE o_custkey % 50 = 0")
def c13_unknown_ids(spark, sf_dir):
    """Updates whose ids the master lacks are reported, not written."""
    u = table(spark, sf_dir, "orders").where("o_custkey % 50 = 0").select((F.col("o_custkey") + 1000000).alias("c_custkey"), F.lit("x").alias("c_mktsegment")).distinct()
    return outcomes.reconcile(table(spark, sf_dir, "customer"), u, "c_custkey", ["c_mktsegment"])[2]


@query(
    "a21_recall_per_plant",
    "WITH f AS (SELECT l_orderkey, min(CASE WHEN l_returnflag = 'R' THEN r END) AS pos FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey) AS r FROM lineitem) GROUP BY 1) SELECT k, round(avg((pos <= k)::INT), 9) AS recall, count(*) AS pools FROM f, (SELECT unnest([1, 3, 5]) AS k) WHERE pos IS NOT NULL GROUP BY 1",
)
def a21_recall_per_plant(spark, sf_dir):
    """Only pools that hold a positive count."""
    r = F.row_number().over(W.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"), "l_linenumber", "l_partkey"))
    f = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", r.alias("r")).groupBy("l_orderkey").agg(F.min(F.when(F.col("l_returnflag") == "R", F.col("r"))).alias("at")).where("at is not null")
    f = f.withColumn("k", F.explode(F.array(*[F.lit(k) for k in (1, 3, 5)])))
    return f.groupBy("k").agg(F.round(F.avg((F.col("at") <= F.col("k")).cast("int")), 9).alias("recall"), F.count(F.lit(1)).alias("pools"))


@query(
    "a31_mcnemar_exact",
    """WITH g AS (SELECT o_custkey % 40 AS g, count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT') AS b, count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F') AS c FROM orders GROUP BY 1)
    SELECT g, b, c, round(least(1.0, 2 * (SELECT sum(exp(lgamma(b + c + 1) - lgamma(i + 1) - lgamma(b + c - i + 1) - (b + c) * ln(2.0))) FROM range(0, least(b, c) + 1) t(i))), 6) AS p FROM g""",
)
def a31_mcnemar_exact(spark, sf_dir):
    o, s, p = table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT"
    g = o.groupBy((F.col("o_custkey") % 40).alias("g")).agg(F.count_if(s & ~p).alias("b"), F.count_if(p & ~s).alias("c"))
    return g.select("g", "b", "c", F.round(metrics.mcnemar(F.col("b"), F.col("c")), 6).alias("p"))


_TOK = "regexp_split_to_array(trim(lower(p_name)), '[^a-z0-9]+')"


@query("j25_similar_tokens")
def j25_similar_tokens(spark, sf_dir):
    """All pairs of names' tokens and types' tokens at an Indel ratio of 80 or more, exactly (no SQL: longest common subsequences)."""
    p = table(spark, sf_dir, "part")
    tok = lambda c, n: p.select(F.explode(F.split(F.lower(c), "[^a-z0-9]+")).alias(n)).distinct()
    return names.similar_tokens(tok("p_name", "tok"), tok("p_name", "u"), 80.0).select("tok", "u", F.round("r", 6).alias("r"))


@query(
    "c14_label_priorities",
    "WITH d AS (SELECT *, CASE WHEN pop > 100 AND pop <= 1000 AND NOT fired THEN 1 WHEN NOT fired THEN 2 WHEN pop > 100 AND pop <= 1000 THEN 3 END AS priority, sha1('p:' || plant) AS h FROM (SELECT c_custkey AS plant, c_nationkey AS state, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS pop, c_custkey % 3 = 0 AS fired, c_custkey % 5 = 0 AS lab FROM customer) WHERE NOT lab AND (pop IS NULL OR pop > 100)), k AS (SELECT *, row_number() OVER (PARTITION BY priority, state ORDER BY h, plant) AS k FROM d WHERE priority IS NOT NULL) SELECT plant, state, priority FROM k ORDER BY priority, k, h, plant LIMIT 60",
)
def c14_label_priorities(spark, sf_dir):
    k = F.col("c_custkey")
    d = table(spark, sf_dir, "customer").select(k.alias("plant"), F.col("c_nationkey").alias("state"), F.when(k % 7 != 0, F.col("c_acctbal")).alias("pop"), (k % 3 == 0).alias("fired"), (k % 5 == 0).alias("labelled"))
    return audit.label_priorities(d, 60)


@query("c15_targeted_sites", "SELECT plant, ll_uuid, min(r) AS role FROM (SELECT l_orderkey AS plant, l_partkey AS ll_uuid, 'a' AS r FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 UNION ALL SELECT l_orderkey, l_partkey, 'b' FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 45) WHERE (plant, ll_uuid) NOT IN (SELECT (l_orderkey, l_partkey) FROM lineitem WHERE l_tax = 0) GROUP BY 1, 2")
def c15_targeted_sites(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("plant"), F.col("l_partkey").alias("ll_uuid"), "l_returnflag", "l_quantity", "l_tax")
    big = li.where("l_quantity > 45")
    d = audit.targeted_sites(big.where("l_returnflag = 'R'"), big.where("l_returnflag = 'A'"), li.where("l_tax = 0").distinct())
    return d.select("plant", "ll_uuid", F.when(F.col("role") == "truth", "a").otherwise("b").alias("role"))


@query(
    "c18_status_report",
    "SELECT 'orders' AS section, '{\"o_orderstatus\":\"' || o_orderstatus || '\",\"n\":' || count(*) || '}' AS line FROM orders GROUP BY o_orderstatus UNION ALL SELECT 'missing', 'failed: AnalysisException'",
)
def c18_status_report(spark, sf_dir):
    """A section that fails is a line, and the others still come."""
    counts = lambda: table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return audit.report({"orders": counts, "missing": lambda: table(spark, sf_dir, "orders").select("no_such_column")})


@query(
    "c19_test_bundle",
    """WITH d AS (SELECT c_custkey AS plant, c_nationkey AS place, c_custkey % 19 = 0 AS corr, c_custkey % 7 = 0 AS lab, c_custkey % 23 = 0 AS held FROM customer), t AS (SELECT place FROM d GROUP BY 1 ORDER BY sum(corr::INT) * 10 + sum(lab::INT) * 2 + count(*) DESC, place LIMIT 3), p AS (SELECT * FROM d WHERE place IN (SELECT place FROM t)), m AS (SELECT * FROM p WHERE corr OR lab OR held)
    SELECT plant FROM m UNION ALL (SELECT plant FROM (SELECT plant, row_number() OVER (ORDER BY sha1('b:' || plant), plant) AS r FROM p WHERE NOT (corr OR lab OR held)) WHERE r <= greatest(0, 100 - (SELECT count(*) FROM m)))""",
)
def c19_test_bundle(spark, sf_dir):
    k = F.col("c_custkey")
    d = table(spark, sf_dir, "customer").select(k.alias("plant"), F.col("c_nationkey").alias("place"), (k % 19 == 0).alias("correction"), (k % 7 == 0).alias("labelled"), (k % 23 == 0).alias("held"))
    return audit.bundle(d, 3, 100).select("plant")


@query("c20_preflight_gates", "SELECT unnest(['covered', 'fresh']) AS gate, round(unnest([avg((c_acctbal >= 0)::INT), avg((c_custkey % 4 > 0)::INT)]), 9) AS share, unnest([avg((c_acctbal >= 0)::INT) >= 0.99, avg((c_custkey % 4 > 0)::INT) >= 0.5]) AS ok FROM customer")
def c20_preflight_gates(spark, sf_dir):
    g = audit.gates(table(spark, sf_dir, "customer"), {"covered": (F.col("c_acctbal") >= 0, 0.99), "fresh": (F.col("c_custkey") % 4 > 0, 0.5)})
    return g.select("gate", F.round("share", 9).alias("share"), "ok")


@query("c21_attrition", "SELECT coalesce(CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders) THEN 'no_order' END, CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'no_open_order' END, '(kept)') AS lost_at, count(*) AS n FROM customer GROUP BY 1")
def c21_attrition(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    d = audit.attrition(table(spark, sf_dir, "customer").select("c_custkey"), [("no_order", o), ("no_open_order", o.where("o_orderstatus = 'P'"))], "c_custkey")
    return d.groupBy(F.coalesce("lost_at", F.lit("(kept)")).alias("lost_at")).agg(F.count(F.lit(1)).alias("n"))


@query("j28_paired_runs", "SELECT o_custkey, count(*) AS n_a, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_b FROM orders GROUP BY 1")
def j28_paired_runs(spark, sf_dir):
    """Two runs over the same plants side by side; a plant that one of them lacks raises."""
    g = table(spark, sf_dir, "orders").groupBy("o_custkey")
    return audit.paired(g.agg(F.count(F.lit(1)).alias("n")), g.agg(F.count_if(F.col("o_orderstatus") == "F").alias("n")), "o_custkey")


@query("u4_label_layers", "SELECT doc_id FROM documents WHERE lang = 'de' UNION SELECT doc_id FROM labels WHERE toxic = 1 UNION SELECT doc_id FROM documents WHERE source = 'src1'")
def u4_label_layers(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.where("lang = 'de'").select("doc_id").union(table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")).union(d.where("source = 'src1'").select("doc_id")).distinct()


@query("m7_validation_split", "SELECT c_custkey, ('0x' || substr(sha1(c_name), 1, 8))::BIGINT / 4294967296.0 < 0.15 AS val FROM customer")
def m7_validation_split(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", (text.hash_fraction(F.col("c_name")) < 0.15).alias("val"))


@query("m4_cells_then_total", "SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY sha1('c:' || c_custkey), c_custkey) AS r FROM customer) WHERE r <= 4 ORDER BY sha1('t:' || c_custkey), c_custkey LIMIT 50")
def m4_cells_then_total(spark, sf_dir):
    """At most four of each cell, then fifty in all."""
    d = sampling.at_most(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], "c_custkey", 4)
    return d.orderBy(sampling.hashed(F.col("c_custkey"), "t"), "c_custkey").limit(50).select("c_custkey")


@query("w17_competition_text", "WITH p AS (SELECT * FROM (SELECT c_mktsegment AS place, c_name AS plant, c_acctbal AS s, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_acctbal DESC, c_name) AS r, c_nationkey FROM customer) WHERE r = 1) SELECT place || c_nationkey AS place, plant, s FROM p")
def w17_competition_text(spark, sf_dir):
    """Ids as text, as the ids of plants and parcels are."""
    d = table(spark, sf_dir, "customer").select(F.concat("c_mktsegment", F.col("c_nationkey").cast("string")).alias("place"), F.col("c_name").alias("plant"), F.col("c_acctbal").alias("s"))
    return ranking.competition(d, "place", "plant", "s").select("place", "plant", "s")
