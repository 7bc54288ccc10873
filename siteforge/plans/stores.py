"""Round trips through every source and sink: the driver's tables are written to a fresh folder of the shared checkpoint store and read back."""
from __future__ import annotations

from pyspark.sql import functions as F

from siteforge.functions import geo
from siteforge.plans.registry import query
from siteforge.sources import readers, shapes, writers
from siteforge.sources.tables import table
from siteforge.storage import new_path


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("id"), F.when(F.col("c_custkey") % 3 != 0, F.concat(F.col("c_name"), F.lit(" \u00e9"))).alias("name"), "c_acctbal")


_CUST = "(SELECT lpad(c_custkey::VARCHAR, 11, '0') AS id, CASE WHEN c_custkey % 3 <> 0 THEN c_name || ' \u00e9' END AS name, c_acctbal FROM customer)"


@query("s1_csv_latin1", f"SELECT id, name, c_acctbal FROM {_CUST}")
def s1_csv_latin1(spark, sf_dir):
    """Ids stay text with their leading zeros; latin1 letters come back."""
    path = new_path(spark, "s1")
    _customers(spark, sf_dir).write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return readers.csv_text(spark, path, "id string, name string, c_acctbal double")


@query("s2_csv_fallback", f"SELECT id, name FROM {_CUST} UNION ALL SELECT id, name FROM {_CUST}")
def s2_csv_fallback(spark, sf_dir):
    """UTF-8 where the file decodes, else latin1: one file of each."""
    out = []
    for enc in ("UTF-8", "ISO-8859-1"):
        path = new_path(spark, "s2")
        _customers(spark, sf_dir).select("id", "name").write.option("header", True).option("encoding", enc).csv(path)
        out.append(readers.csv_decoded(spark, path, "id string, name string"))
    return out[0].unionByName(out[1])


@query("s3_csv_renamed", "SELECT c_custkey::VARCHAR AS key, c_mktsegment AS seg FROM customer")
def s3_csv_renamed(spark, sf_dir):
    path = new_path(spark, "s3")
    table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").write.option("header", True).csv(path)
    return readers.csv_renamed(spark, path, ["key", "seg"])


@query("s4_csv_strings", f"SELECT id, coalesce(name, '') AS name FROM {_CUST}")
def s4_csv_strings(spark, sf_dir):
    """Every column as text, blanks as ''."""
    path = new_path(spark, "s4")
    writers.csv_table(_customers(spark, sf_dir).select("id", "name"), path)
    return readers.csv_strings(spark, path)


@query("s5_column_list", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def s5_column_list(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_totalprice > 300000").select("o_orderkey", "o_totalprice")


def _store(spark, sf_dir):
    path = new_path(spark, "store")
    writers.append_parts(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("state")), path)
    return path


@query("s6_hive_partition", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def s6_hive_partition(spark, sf_dir):
    return readers.hive_partition(spark, _store(spark, sf_dir), "P").select("o_orderkey", "o_totalprice")


@query("s7_parts_in_order", "SELECT user_id, event_id FROM (SELECT user_id, min(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY 1) UNION ALL SELECT user_id, event_id FROM (SELECT user_id, min(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1) WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'click')")
def s7_parts_in_order(spark, sf_dir):
    """Part files written one after another; the newest one's row of a key stays."""
    path, e = new_path(spark, "s7"), table(spark, sf_dir, "events")
    for kind in ("view", "click"):
        one = e.where(F.col("event_type") == kind).groupBy("user_id").agg(F.min("event_id").alias("event_id"))
        one.coalesce(1).write.mode("append").parquet(path)
    return readers.parts_in_order(spark, path, ["user_id"]).select("user_id", "event_id")


@query("s8_newer_files", "SELECT count(*) AS n, 0 AS later FROM nation")
def s8_newer_files(spark, sf_dir):
    """Files newer than a moment long gone, and newer than one to come."""
    path = new_path(spark, "s8")
    table(spark, sf_dir, "nation").write.parquet(path)
    n = readers.newer_than(spark, path, "2000-01-01").agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(readers.newer_than(spark, path, "2990-01-01").agg(F.count(F.lit(1)).cast("int").alias("later"))))


@query("s9_root_priority", "SELECT k, v FROM (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 4 <> 0 UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT c_custkey + 10000000, 'new' FROM customer WHERE c_custkey % 400 = 0)")
def s9_root_priority(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    later = c.where("c_custkey % 4 = 0").select(k.alias("k"), F.lit("new").alias("v")).unionByName(c.where("c_custkey % 400 = 0").select((k + 10000000).alias("k"), F.lit("new").alias("v")))
    return readers.by_priority([c.select(k.alias("k"), F.col("c_mktsegment").alias("v")), later], ["k"])


@query("s11_newest_layer", "SELECT 'master_20261103_v2' AS layer, 'master_20261101' AS complete")
def s11_newest_layer(spark, sf_dir):
    """The newest dated layer, and the newest that has the columns (S11, S12)."""
    layers = {"master_20261101": ["id", "Verified"], "master_20261103": ["id"], "master_20261103_v2": ["id"], "master_10302026": ["id", "Verified"]}
    return spark.createDataFrame([(readers.newest_layer(list(layers)), readers.newest_with(layers, ["Verified"]))], "layer string, complete string")


@query("s10_vector_layer", "SELECT p_partkey, round((p_size * 10.0) * (p_size * 7.0), 6)::DOUBLE AS area FROM part")
def s10_vector_layer(spark, sf_dir):
    """A layer by name: shapes as well-known binary, read back as rings."""
    path, s = new_path(spark, "s10"), F.col("p_size")
    ring = geo.box_ring(F.lit(0.0), F.lit(0.0), s * 10.0, s * 7.0)
    table(spark, sf_dir, "part").select("p_partkey", shapes.ring_wkb(ring).alias("wkb_geometry")).write.parquet(f"{path}/parcels")
    return readers.vector_layer(spark, path, "parcels").select("p_partkey", F.round(geo.ring_area(F.col("ring")), 6).alias("area"))


@query("s12_newest_complete_layer", "SELECT 'master_20261101' AS layer")
def s12_newest_complete_layer(spark, sf_dir):
    layers = {"master_20261101": ["id", "Verified"], "master_20261103_v2": ["id"], "master_09302026": ["id", "Verified"]}
    return spark.createDataFrame([(readers.newest_with(layers, ["id", "Verified"]),)], "layer string")


@query("s13_state_query", "SELECT n_regionkey AS region, count(*) AS n FROM nation GROUP BY 1")
def s13_state_query(spark, sf_dir):
    """A query over a review's state database (in memory here)."""
    import sqlite3

    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE nation (k INTEGER, r INTEGER)")
    con.executemany("INSERT INTO nation VALUES (?, ?)", [(r.n_nationkey, r.n_regionkey) for r in table(spark, sf_dir, "nation").collect()])  # 25 rows
    return readers.state_query(spark, con, "SELECT r, count(*) FROM nation GROUP BY r", "region int, n long")


@query("s14_join_using", "SELECT p_brand, count(*) AS n, sum(l_quantity) AS q FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def s14_join_using(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_brand")
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), "l_quantity").join(p, on="id").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))


@query("s16_footer", "SELECT count(*) AS n, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS cols FROM orders")
def s16_footer(spark, sf_dir):
    n, cols = readers.footer(spark, f"{sf_dir}/orders.parquet")
    return spark.createDataFrame([(n, ",".join(cols))], "n long, cols string")


@query("s17_two_level_partition", "SELECT c_custkey FROM customer WHERE c_nationkey = 3 AND c_mktsegment = 'BUILDING'")
def s17_two_level_partition(spark, sf_dir):
    path = new_path(spark, "s17")
    table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("state"), F.col("c_mktsegment").alias("geoid")).write.partitionBy("state", "geoid").parquet(path)
    return readers.partition_of(spark, path, state=3, geoid="BUILDING").select("c_custkey")


@query("s22_box_labels", "SELECT p_partkey % 6 AS class, round(p_size / 50.0, 6) AS x, 0.5::DOUBLE AS y FROM part WHERE p_partkey % 10 <> 0")
def s22_box_labels(spark, sf_dir):
    """Lines of class and four shares; every tenth line is broken and left out."""
    path, k = new_path(spark, "s22"), F.col("p_partkey")
    line = F.when(k % 10 == 0, "no box here").otherwise(F.concat_ws(" ", (k % 6).cast("string"), F.format_string("%.6f", F.col("p_size") / 50.0), F.lit("0.5 0.1 0.1")))
    table(spark, sf_dir, "part").select(line.alias("value")).write.text(path)
    return readers.box_labels(spark, path).select("class", "x", "y")


@query("s23_partitions", "SELECT DISTINCT o_orderstatus AS state FROM orders")
def s23_partitions(spark, sf_dir):
    return spark.createDataFrame([(s,) for s in readers.partitions(spark, _store(spark, sf_dir))], "state string")


@query("k1_flat_write", "SELECT n_nationkey, n_name FROM nation")
def k1_flat_write(spark, sf_dir):
    path = new_path(spark, "k1")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.parquet(path)
    return spark.read.parquet(path)


@query("k2_append_parts", "SELECT o_orderstatus AS state, count(*) AS n FROM orders GROUP BY 1")
def k2_append_parts(spark, sf_dir):
    return spark.read.parquet(_store(spark, sf_dir)).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query("k3_partition_overwrite", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders")
def k3_partition_overwrite(spark, sf_dir):
    """Only the partition that the new rows hold is replaced."""
    path = _store(spark, sf_dir)
    new = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_orderkey", F.lit(0.0).alias("o_totalprice"), F.col("o_orderstatus").alias("state"))
    writers.overwrite_partitions(new, path)
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice")


@query("k4_validated_merge", "SELECT c_custkey, c_mktsegment FROM customer")
def k4_validated_merge(spark, sf_dir):
    """All shards checked and written aside before any table is replaced; newer than their sources (K5)."""
    out, c = new_path(spark, "k4"), table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    for _ in range(2):  # the second run replaces the first one's table
        writers.merge_shards({"plants": [c.where("c_custkey % 2 = 0"), c.where("c_custkey % 2 = 1")]}, {"plants": ["c_custkey"]}, out, 2, {"plants": (2, 1)})
    return spark.read.parquet(f"{out}/plants")


@query("k5_stale_refusal", "SELECT 'refused' AS outcome, count(*) AS n FROM nation")
def k5_stale_refusal(spark, sf_dir):
    """A shard older than its source is refused, and what was there stays."""
    out, d = new_path(spark, "k5"), table(spark, sf_dir, "nation").select("n_nationkey")
    writers.merge_shards({"t": [d]}, {"t": ["n_nationkey"]}, out, 1)
    try:
        writers.merge_shards({"t": [d.limit(1)]}, {"t": ["n_nationkey"]}, out, 1, {"t": (1, 2)})
        outcome = "taken"
    except ValueError:
        outcome = "refused"
    return spark.read.parquet(f"{out}/t").agg(F.lit(outcome).alias("outcome"), F.count(F.lit(1)).alias("n"))


@query("k7_geojson_lines", "SELECT c_custkey, '{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":[' || -(c_custkey % 90) || '.5,' || c_custkey % 80 || '.25]},\"properties\":{\"seg\":\"' || c_mktsegment || '\"}}' AS j FROM customer WHERE c_custkey % 90 > 0")
def k7_geojson_lines(spark, sf_dir):
    """Point features as lines of text, the form that map tools read (layers of other formats are made from it)."""
    k = F.col("c_custkey")
    f = writers.geojson(-(k % 90) - 0.5, k % 80 + 0.25, F.col("c_mktsegment").alias("seg"))
    path = new_path(spark, "k7")
    table(spark, sf_dir, "customer").where("c_custkey % 90 > 0").select("c_custkey", f.alias("j")).write.json(path)
    return spark.read.schema("c_custkey long, j string").json(path)


@query("k8_atomic_replace", "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0")
def k8_atomic_replace(spark, sf_dir):
    """Replaced only when the written rows are as many as expected; a wrong number leaves the old table."""
    path, c = new_path(spark, "k8"), table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    c.write.parquet(path)
    even = c.where("c_custkey % 2 = 0")
    try:
        writers.replace_table(c.limit(1), path, 2)
        raise AssertionError("a short table was taken")
    except ValueError:
        pass
    writers.replace_table(even, path, even.count())
    return spark.read.parquet(path)


@query("k9_compact_export", "SELECT c_custkey, c_acctbal::FLOAT AS c_acctbal, c_acctbal AS lat FROM customer")
def k9_compact_export(spark, sf_dir):
    path = new_path(spark, "k9")
    writers.compact(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_acctbal").alias("lat")), path)
    return spark.read.parquet(path)


@query("k11_schema_sidecar", "SELECT 'ColNameHeader=True' AS line UNION ALL SELECT 'Format=CSVDelimited' UNION ALL SELECT 'CharacterSet=65001' UNION ALL SELECT 'Col1=n_nationkey Text Width ' || least(255, greatest(10, max(length(n_nationkey::VARCHAR)) + 20)) FROM nation UNION ALL SELECT 'Col2=n_name Text Width ' || least(255, greatest(10, max(length(n_name)) + 20)) FROM nation")
def k11_schema_sidecar(spark, sf_dir):
    lines = writers.schema_sidecar(table(spark, sf_dir, "nation").select("n_nationkey", "n_name")).split("\r\n")
    return spark.createDataFrame([(x,) for x in lines], "line string")


@query("k12_payload", "SELECT '{\"cols\":[\"r_regionkey\",\"r_name\"],\"rows\":[' || string_agg('[\"' || r_regionkey || '\",\"' || r_name || '\"]', ',' ORDER BY r_regionkey) || ']}' AS json FROM region")
def k12_payload(spark, sf_dir):
    return writers.payload(table(spark, sf_dir, "region"), ["r_regionkey", "r_name"], ["r_regionkey"])


@query("k13_geojson", "SELECT c_custkey, json_extract(j, '$.geometry.coordinates[0]')::DOUBLE AS x FROM (SELECT c_custkey, '{\"geometry\":{\"coordinates\":[' || c_custkey / 8.0 || ']}}' AS j FROM customer)")
def k13_geojson(spark, sf_dir):
    f = writers.geojson(F.col("c_custkey") / 8.0, F.lit(1.0), F.col("c_name").alias("name"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.get_json_object(f, "$.geometry.coordinates[0]").cast("double").alias("x"))
