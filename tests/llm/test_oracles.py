from __future__ import annotations

import duckdb
import pytest

from stockweave.llm.oracles import ORACLES
from stockweave.llm.queries import QUERIES
from tests.llm import tables
from tests.llm.test_url_filter import CANONICAL, REFRESH

SF_DIR = "/root/testdata/sf0.01"
PAGES = [
    (1, "http://a.org/1", CANONICAL.format("http://b.org/2?x=1&amp;y=2")), (2, "https://b.org/2?x=1&y=2#top", REFRESH.format("/3")),
    (3, "http://b.org/3", CANONICAL.format("//bad.net/es/4")), (4, "http://www.example.com/en/5", CANONICAL.format("http://a.org/1")),
    (5, "http://free.org/dir/6", CANONICAL.format("7")), (6, "http://free.org/dir/7", None), (7, None, CANONICAL.format("http://bad.net/fr/")),
    (8, "http://c.org/8", "<link href=http://bad.net/fr/ rel=canonical>"), (9, "http://C.org/9?q", "<link rel='canonical' href='?p'>"),
    (9, "http://C.org/9?q", None), (10, "no scheme", CANONICAL.format("http://bad.net/fr/")), (None, "http://x.net/es/", ""),
]


def plain(rows):
    return sorted(map(str, rows))


def compare(spark, folder, files, name, tables_read):
    made = QUERIES[name](spark, folder)
    connection = duckdb.connect()
    for table in tables_read:
        connection.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet{files}')")
    cursor = connection.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(made.columns)
    assert plain(map(tuple, made.select(*names).collect())) == plain(cursor.fetchall())


@pytest.mark.parametrize(("name", "tables_read"), [
    ("op5_exact_dedup", ["documents"]), ("op6_url_filter", ["pages"]), ("op11_filter_audit", ["documents", "labels"]),
])
def test_queries_match_their_sql(spark, name, tables_read):
    compare(spark, SF_DIR, "", name, tables_read)


def test_sql_of_odd_rows(spark, tmp_path):
    tables.documents(spark, tables.odd_rows()).write.parquet(f"{tmp_path}/documents.parquet")
    compare(spark, str(tmp_path), "/*.parquet", "op5_exact_dedup", ["documents"])
    spark.createDataFrame([(i, i % 2, i % 3 - 1) for i in range(0, 310, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    compare(spark, str(tmp_path), "/*.parquet", "op11_filter_audit", ["documents", "labels"])
    spark.createDataFrame(PAGES, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    compare(spark, str(tmp_path), "/*.parquet", "op6_url_filter", ["pages"])


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
