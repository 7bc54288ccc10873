"""Decisions about plants: status cascades, outcome classes, verdict checks, training bins, the final output."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteforge.functions import geo

# Categories that describe a sewage system, those that keep a code-only permit large, and a household's flow (MGD).
SEWER_CATEGORIES = ["040", "053", "054", "055", "056", "057", "058", "062", "082", "096", "97I"]
LARGE_CATEGORIES = ["055", "056", "057", "058", "97I"]
HOUSEHOLD_FLOW = 0.1
SITE_TIE_MARGIN, MULTI_PASS_MARGIN, MULTI_PASS_DIST_M = 0.02, 0.05, 1000.0


def cascade(rules: list[tuple[Column, object]], default=None) -> Column:
    """The value of the first rule that holds; a null condition does not hold."""
    out = F.lit(default)
    for condition, value in reversed(rules):
        out = F.when(condition, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def text_true(c: Column) -> Column:
    """Booleans in any spelling: true, 1 or 1.0; anything else and null is false."""
    return F.coalesce(F.lower(c.cast("string")).isin("true", "1", "1.0"), F.lit(False))


def confidence_tier(status: Column, band: Column) -> Column:
    """verified before model before model_small_plant; what nobody decided is none."""
    decided = status.isin("moved", "kept_site", "kept_model", "kept_osm", "flagged_not_moved")
    return cascade([(status.isin("verified_correct", "verified_corrected"), "verified"), (decided & ~band.eqNullSafe(F.lit(">1k")), "model_small_plant"), (decided, "model")], "none")


def location_basis(status: Column, move_path: Column) -> Column:
    """Who a location rests on; a moved plant's path decides."""
    return cascade(
        [
            (status == "moved", F.when(move_path == "stage1_seed", "stage1_accept_seed").when(move_path == "stage2", "stage2_move")),
            (status.isin("verified_correct", "verified_corrected", "reviewed_unresolved"), "reviewer"),
            (status.isin("kept_model", "kept_osm"), "stage1_accept"),
            (status.isin("kept_site", "flagged_not_moved", "not_assessed"), status),
        ]
    )


def holdout_outcome(scored: Column, truth: Column, trigger: Column, accepted: Column, reported: Column, first: Column) -> Column:
    """End-to-end outcome of a held-out plant; accepted: the accepted site's parcels (null or empty: the reported one counts)."""
    known = F.coalesce(truth, F.lit("")) != ""
    site = F.when(F.coalesce(F.size(accepted), F.lit(0)) > 0, accepted).otherwise(F.array(reported))
    return cascade(
        [
            (~F.coalesce(scored, F.lit(False)), "not_scored"),
            (~known, "truth_unresolved"),
            ((trigger == "none") & F.coalesce(F.array_contains(site, truth), F.lit(False)), "accepted_right"),
            (trigger == "none", "accepted_wrong"),
            (first == truth, "moved_right"),
        ],
        "flagged_wrong",
    )


def review_outcome(verdict: Column, rank: Column, site: Column, top: Column) -> Column:
    """Outcome of a reviewed move; site: the reviewer's parcels joined by ;, which override a plain mismatch."""
    in_site = F.coalesce(F.array_contains(F.split(site, ";"), top), F.lit(False)) & (top != "")
    return cascade(
        [
            (verdict.isin("candidate_correct", "reported_correct") & in_site, "right"),
            (verdict == "reported_correct", "false_move"),
            (verdict == "truth_outside_candidates", "truth_outside"),
            ((verdict == "candidate_correct") & (rank == 1), "right"),
            (verdict == "candidate_correct", "wrong_candidate"),
        ],
        "needs_info",
    )


def coverage_cause(corrected: Column, in_features: Column, in_raster: Column, in_ring: Column, in_window: Column) -> Column:
    """Why a correction can't be learnt from: five exclusive causes."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return cascade(
        [
            (corrected.isNull(), "b_no_parcel_at_corrected_point"), (in_features, "ok_usable"), (in_raster, "d_lost_in_02_join"),
            (no(in_ring) & no(in_window), "a_outside_search_window"),
        ],
        "c_in_window_but_no_nlcd_row",
    )


def permit_tier(kind: Column, category: Column, treatment: Column, named: Column, flow: Column) -> Column:
    return cascade(
        [
            ((kind == "GPC") & category.isNotNull() & ~category.isin(*SEWER_CATEGORIES), "nonsewer_category"),
            (treatment | named, "core"),
            (F.coalesce(category, F.lit("")).isin(*LARGE_CATEGORIES) | (F.coalesce(flow, F.lit(0.0)) >= HOUSEHOLD_FLOW), "code_large"),
        ],
        "code_household",
    )


def permit_universe(permits: DataFrame, facilities: DataFrame, codes: DataFrame, cutoff: str) -> DataFrame:
    """The lowest version of each live permit (permit, version, kind, status, ended, retired, expires, treatment, name, category, flow)
    with its facility's name and sewerage code, its tier, and whether any of its versions treats (treatment_any)."""
    day = F.lit(cutoff).cast("timestamp_ntz")
    any_version = permits.groupBy("permit").agg(F.bool_or("treatment").alias("treatment_any"))
    rest = [c for c in permits.columns if c not in ("permit", "version")]
    low = permits.groupBy("permit").agg(F.min(F.struct("version", *rest)).alias("m")).select("permit", "m.*")
    ok = lambda c: F.col(c).isNull() | (F.col(c) >= day)
    live = ok("ended") & ok("retired") & (F.col("status").isin("EFF", "ADC") | F.coalesce(F.col("expires") >= day, F.lit(False)))
    d = low.where(live).join(any_version, "permit").join(facilities, "permit", "left").join(codes, "permit", "left")
    coded = F.coalesce(F.col("sewerage"), F.lit(False))
    named = F.upper(F.coalesce("facility", "name", F.lit(""))).rlike(SEWER_NAMES)
    d = d.withColumns({"sewer_named": named, "sewerage": coded}).where("treatment_any or sewer_named or sewerage")
    return d.withColumn("tier", permit_tier(F.col("kind"), F.col("category"), F.col("treatment_any"), F.col("sewer_named"), F.col("flow")))


# Fixed value: names that sound like a sewage system.
SEWER_NAMES = r"WWTP|WWTF|WASTEWATER|WASTE WATER|SEWER|SEWAGE|WPCF|WPCP|\bSTP\b|POTW|TREATMENT (PLANT|FACILITY)|WATER POLLUTION|RECLAMATION|SANITARY"


def verdict_columns(verdict: Column, task: Column, x: Column, y: Column, reported: Column, selected: Column, extras: Column) -> Column:
    """What a verdict writes into the master, as a struct; null if it resolves nothing (a move without a point)."""
    site = lambda first: F.array_join(F.array_distinct(F.filter(F.concat(F.array(first), F.split(F.coalesce(extras, F.lit("")), ";")), lambda u: u != "")), ";")
    none = F.lit(None)
    kept = F.struct(
        F.lit("Yes").alias("Verified"), F.lit("Yes").alias("Original_Correct"), F.lit("No").alias("Corrected"), none.cast("double").alias("Corrected_X"),
        none.cast("double").alias("Corrected_Y"), none.cast("string").alias("How_Corrected"), site(reported).alias("Site_UUIDs"),
    )
    how = F.when(task == "viewer", "viewer").when(verdict == "candidate_correct", "model").otherwise("manual")
    moved = F.struct(
        F.lit("Yes").alias("Verified"), F.lit("No").alias("Original_Correct"), F.lit("Yes").alias("Corrected"), x.alias("Corrected_X"), y.alias("Corrected_Y"),
        how.alias("How_Corrected"), F.when(verdict == "candidate_correct", site(selected)).alias("Site_UUIDs"),
    )
    return F.when(verdict == "reported_correct", kept).when(x.isNotNull() & y.isNotNull(), moved)


def verdict_violations(verdict: Column, selected: Column, rank: Column, lat: Column, lon: Column, site: Column, confirmation: Column) -> Column:
    """Names of the required-iff rules that a verdict breaks."""
    confirms = verdict.isin("reported_correct", "candidate_correct")
    return F.array_compact(
        F.array(
            F.when((verdict == "candidate_correct") & (selected.isNull() | rank.isNull()), "candidate"),
            F.when((verdict == "truth_outside_candidates") & (lat.isNull() | lon.isNull()), "truth"),
            F.when((F.coalesce(site, F.lit("")) != "") & ~confirms, "site"),
            F.when(confirms & confirmation.isNull(), "confirmation"),
        )
    )


def training_bins(master: DataFrame, key: str) -> DataFrame:
    """(key, bin, usable) of a master with Verified, Original_Correct, Corrected, Original_X/Y and Corrected_X/Y: Correct, Incorrect,
    correction (an Incorrect one with a known answer, once more) and unverified. A key in both Correct and Incorrect raises."""
    verified = F.coalesce("Verified", F.lit("No")) == "Yes"
    there = F.col("Original_X").isNotNull() & F.col("Original_Y").isNotNull()
    wrong = verified & (F.col("Original_Correct") == "No")
    fixed = wrong & (F.col("Corrected") == "Yes") & F.col("Corrected_X").isNotNull() & F.col("Corrected_Y").isNotNull()
    bins = F.array_compact(F.array(F.when(~verified, "unverified"), F.when(verified & (F.col("Original_Correct") == "Yes"), "Correct"), F.when(wrong, "Incorrect"), F.when(fixed, "correction")))
    out = master.where(there).select(key, F.explode(bins).alias("bin"))
    both = out.where("bin in ('Correct', 'Incorrect')").groupBy(key).agg(F.count_distinct("bin").alias("n")).where("n > 1")
    if not both.isEmpty():
        raise ValueError("a plant is in both the Correct and the Incorrect bin")
    return out


def detection_state(n_objects: Column, evaluated: Column, imagery: Column) -> Column:
    return cascade([(~F.coalesce(evaluated, F.lit(False)), "not_evaluated"), (~F.coalesce(imagery, F.lit(False)), "no_imagery"), (n_objects > 0, "detected")], "none_found")


def fill_by_prefix(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Nulls of the columns that begin with a prefix become its value; other columns keep theirs."""
    values = {c: v for c in df.columns for p, v in fills.items() if c.startswith(p)}
    return df.na.fill(values) if values else df


def without(df: DataFrame, columns: list[str]) -> DataFrame:
    """df less the columns, those that are absent tolerated."""
    return df.drop(*columns)


def kept(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the list that df has, in the list's order."""
    return df.select(*[c for c in columns if c in df.columns])


def aligned(df: DataFrame, trained: list[str]) -> DataFrame:
    """df's columns in the trained order; an absent or a non-scalar one raises."""
    kinds = dict(df.dtypes)
    absent = [c for c in trained if c not in kinds]
    if absent:
        raise KeyError(f"columns are absent: {absent}")
    nested = [c for c in trained if kinds[c].startswith(("array", "map", "struct", "binary"))]
    if nested:
        raise TypeError(f"columns are not scalar: {nested}")
    return df.select(*trained)


def legend(df: DataFrame, states: list[str], low: float, high: float, statuses: list[str]) -> DataFrame:
    """(status, n, shown): counts under the state and population filters, which the status filter does not change."""
    inside = df.where(F.col("state").isin(*states) & F.col("pop").between(low, high))
    return inside.groupBy("status").agg(F.count(F.lit(1)).alias("n")).withColumn("shown", F.col("status").isin(*statuses))


def id_valid(c: Column, length: int, prefixes: list[str]) -> Column:
    return F.coalesce((F.length(c) == length) & F.substring(c, 1, len(prefixes[0])).isin(*prefixes), F.lit(False))


def reserve(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """rows, unless one is reserved by another round, which raises."""
    if not rows.join(others.select(key), key, "left_semi").isEmpty():
        raise ValueError("rows are reserved by another round")
    return rows


def site_decision(sites: DataFrame, plants: DataFrame, threshold: float) -> DataFrame:
    """Per plant: the best site and whether it is accepted.

    sites (plant, site_id, rep, sources, n_origins, n_seeds, has_cwns_point, site_rank, prob, osm, lat, lon); plants (plant). A
    site with a map tag passes by rule, and then only such sites compete. Near ties (SITE_TIE_MARGIN) go to more independent origins,
    then the site of the plant's own point, then the probability, then the rank. The runner-up is the best other site; multi_pass marks two that
    both clear the threshold, lie apart and score alike.
    """
    order = lambda *c: F.struct(*c)
    sites = sites.select("plant", "site_id", "rep", "sources", "n_origins", "n_seeds", "has_cwns_point", "site_rank", "prob", "osm", "lat", "lon")
    pool = sites.groupBy("plant").agg(F.bool_or("osm").alias("any_osm"), F.max(F.when(F.col("osm"), F.col("prob"))).alias("top_osm"), F.max("prob").alias("top"), F.count(F.lit(1)).alias("n_sites"))
    s = sites.join(pool, "plant")
    s = s.withColumn("top", F.when(F.col("any_osm"), F.col("top_osm")).otherwise(F.col("top")))
    near = s.where((~F.col("any_osm") | F.col("osm")) & (F.col("prob") >= F.col("top") - SITE_TIE_MARGIN))
    fields = ["site_id", "rep", "sources", "n_origins", "n_seeds", "prob", "lat", "lon"]
    best = near.groupBy("plant").agg(F.min(order(-F.col("n_origins"), ~F.col("has_cwns_point"), -F.col("prob"), "site_rank", F.struct(*fields).alias("v")))["v"].alias("best"), F.first("any_osm").alias("osm"), F.first("n_sites").alias("n_sites"))
    rest = sites.join(best.select("plant", F.col("best.site_id").alias("b_")), "plant").where("site_id <> b_")
    alt = rest.groupBy("plant").agg(F.min(order(-F.col("prob"), -F.col("n_origins"), "site_rank", F.struct("site_id", "sources", "prob", "lat", "lon").alias("v")))["v"].alias("alt"))
    d = plants.join(best, "plant", "left").join(alt, "plant", "left")
    accepted = F.coalesce(F.col("osm") | (F.col("best.prob") >= threshold), F.lit(False))
    apart = geo.haversine_m(F.col("best.lat"), F.col("best.lon"), F.col("alt.lat"), F.col("alt.lon"))
    multi = accepted & (F.col("alt.prob") >= threshold) & (apart > MULTI_PASS_DIST_M) & (F.abs(F.col("best.prob") - F.col("alt.prob")) <= MULTI_PASS_MARGIN)
    return d.select(
        *plants.columns, F.col("best.rep").alias("reported_ll_uuid"), F.col("best.prob").alias("prob"), F.col("best.site_id").alias("best_site_id"), F.col("best.sources").alias("best_site_sources"),
        F.when(accepted, F.col("best.site_id")).alias("accepted_site_id"), F.when(accepted, F.col("best.sources")).alias("accepted_sources"), F.col("alt.site_id").alias("alt_site_id"), apart.alias("alt_dist_m"),
        F.coalesce(multi, F.lit(False)).alias("multi_pass"), F.coalesce("n_sites", F.lit(0)).alias("n_sites"), accepted.alias("accepted"),
        cascade([(F.col("best").isNull(), "no_parcel"), (F.col("osm"), "osm_confirmed")], "model").alias("route"),
        cascade([(F.col("best").isNull(), "no_parcel"), (accepted, "none")], "low_confidence").alias("trigger_reason"),
    )


def corrected_output(df: DataFrame, cutoff: float, require_detection: bool = False) -> DataFrame:
    """df with status, status_reason, move_path, out_lat, out_lon, moved_m, loc_basis and confidence_tier.

    Needs Verified, Original_Correct, Corrected_X/Y, How_Corrected, route, trigger_reason, accepted_sources, top, top_score, fallback,
    top_lat, top_lon (where the move would go; null if its parcel is not found), reported_in_site, reported_lat/lon, state_scored, pop_ok, pop_band.
    Reviewers come first, then what was not assessed and why, then kept, moved and flagged plants.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    verified, wrong = F.coalesce(F.col("Verified") == "Yes", F.lit(False)), F.coalesce(F.col("Original_Correct") == "No", F.lit(False))
    fixed = verified & wrong & F.col("Corrected_X").isNotNull()
    open_ = F.col("route").isNotNull()
    flagged = F.coalesce(F.col("trigger_reason").isin("low_confidence", "no_parcel"), F.lit(False))
    seed = open_ & (F.col("trigger_reason") == "none") & F.coalesce(~F.col("accepted_sources").contains("cwns_point"), F.lit(False))
    can = flagged & F.col("top").isNotNull() & F.coalesce(F.col("top_score") >= cutoff, F.lit(False))
    if require_detection:
        can = can & ~F.coalesce(F.col("fallback"), F.lit(True))
    placed = F.col("top_lat").isNotNull()
    unassessed = cascade([(F.col("reported_lat").isNull(), "no_coordinates"), (~yes("state_scored"), "no_imagery_state"), (~yes("pop_ok"), "population_low_or_unknown")], "not_scored")
    rules = [
        (verified & F.coalesce(F.col("Original_Correct") == "Yes", F.lit(False)), "verified_correct", F.lit("")),
        (fixed, "verified_corrected", F.coalesce("How_Corrected", F.lit(""))),
        (wrong, "reviewed_unresolved", F.lit("")),
        (~open_, "not_assessed", unassessed),
        (seed & placed, "moved", F.lit("accepted site does not hold the reported point")),
        (seed, "kept_model", F.lit("seed_site_not_placed")),
        (F.col("route") == "osm_confirmed", "kept_osm", F.lit("")),
        (F.col("trigger_reason") == "none", "kept_model", F.lit("")),
        (can & ~placed, "flagged_not_moved", F.lit("move_parcel_not_found")),
        (can & yes("reported_in_site"), "kept_site", F.lit("reported parcel is part of the first site")),
        (can, "moved", F.lit("")),
        (flagged, "flagged_not_moved", F.col("trigger_reason")),
    ]
    d = df.withColumns({"status": cascade([(c, s) for c, s, _ in rules], "not_assessed"), "status_reason": cascade([(c, r) for c, _, r in rules], "unrouted")})
    d = d.withColumn("move_path", cascade([(~F.col("status").isin("moved", "kept_site"), ""), (seed, "stage1_seed")], "stage2"))
    to = lambda fixed_c, top_c, old: F.when(F.col("status") == "verified_corrected", F.col(fixed_c)).when(F.col("status") == "moved", F.col(top_c)).otherwise(F.col(old))
    d = d.withColumns({"out_lat": to("Corrected_Y", "top_lat", "reported_lat"), "out_lon": to("Corrected_X", "top_lon", "reported_lon")})
    far = geo.haversine_m(F.col("reported_lat"), F.col("reported_lon"), F.col("out_lat"), F.col("out_lon"))
    return d.withColumns(
        {
            "moved_m": F.when(F.col("status").isin("moved", "verified_corrected"), far).otherwise(0.0),
            "loc_basis": location_basis(F.col("status"), F.col("move_path")),
            "confidence_tier": confidence_tier(F.col("status"), F.col("pop_band")),
        }
    )


def reconcile(master: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(master with the updates, changes (key, column, old, new), unknown keys): only the given columns are written, null never overwrites."""
    both = master.join(updates.select(key, *[F.col(c).alias(f"{c}_new") for c in columns]), key, "left")
    out = both.select(*[F.coalesce(F.col(f"{c}_new"), F.col(c)).alias(c) if c in columns else F.col(c) for c in master.columns])
    moved = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("old"), F.col(f"{c}_new").cast("string").alias("new")) for c in columns])
    log = both.select(key, F.explode(moved).alias("m")).select(key, "m.*").where("new is not null and not (old <=> new)")
    return out, log, updates.join(master.select(key), key, "left_anti").select(key)
