"""The SQL of each operator that has one, against the operator on nulls, empty and repeated rows, and linked hosts."""
from collections import Counter

import duckdb
import pytest

from siteforge.llm import registry

TEXT = "Clear prose with several words stands on this line and says little.\n"
PASSAGE = " ".join(f"item{i} holds{i * 3}" for i in range(12))
DOCS = [
    (1, TEXT * 3), (1, TEXT * 3), (2, None), (3, ""), (None, "Home | About | Contact\n" + TEXT), (4, "a b c d e f a b c d e g x | y"), (5, "All Rights Reserved here\n\n## $$ %% ## $$ %% && ** words\n" + TEXT),
    (6, "before " + PASSAGE.upper() + ", after"), (7, PASSAGE.replace("item4", "other").replace("holds21", "more")), (8, " ".join(PASSAGE.split()[:9])), (9, "ein Wörterbuch › Über › uns\n" + TEXT),
]
ITEMS = [(1, PASSAGE), (2, None), (3, "too short"), (1, PASSAGE), (4, " ".join(PASSAGE.split()[3:14]))]
PAGES = [
    (1, "http://Example.net/en/x?q#f", '<a href="//far.site/">'), (2, "https://a.example.net", ""), (3, None, None), (4, "no scheme", None), (5, "http://b.net/x", '<img src=http://far.site/i>'), (6, "http://s.example.com/de/", None),
    (7, "http://q.org/fr/1", '<a HREF = "http://good.site/"> <a href="/own">'), (8, "http://linker.site/1", "<a href='http://b.net/x'> <a href=\"//s.example.com/de/a\">"), (8, "http://linker.site/1", None), (9, "http://good.site/p", None), (10, "http://far.site/", None),
]
TABLES = {"documents": ("doc_id long, text string", DOCS), "benchmark": ("item_id long, text string", ITEMS), "pages": ("page_id long, url string, html string", PAGES)}


@pytest.mark.parametrize("part", ["all", "none"])
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql_gives_the_same_rows(spark, tmp_path, name, part):
    con = duckdb.connect()
    for table, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows if part == "all" else [], schema).repartition(2).write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    out = registry.queries()[name](spark, str(tmp_path))
    columns = sorted(out.columns)
    got = Counter(tuple(r[c] for c in columns) for r in out.collect())
    found = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in at) for r in found.fetchall())
    assert got == want and (part == "none" or got)
