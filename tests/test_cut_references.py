"""Pages whose text breaks off inside a character reference, against the SQL of the queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalith.functions import html as H

HTML = ['<title>and&amp</title><h1>a&amp;b &quo</h1><a href="/x">c&copy</a>', "<title>ver&amp;&amp</title>&lt;p&gt &middot;", "<title>plain</title>"]


@pytest.mark.parametrize("name", ["q21_html_title", "q64_html_text", "q20_html_links"])
def test_same_as_the_sql(spark, tmp_path, name):
    rows = [(i, "https://h.example/a", h) for i, h in enumerate(HTML)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    sql = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in sql.description]
    assert sorted(map(tuple, entry.queries()[name](spark, str(tmp_path)).select(*names).collect())) == sorted(sql.fetchall())


def test_the_operator_still_reads_bare_references(spark):
    text = spark.range(1).select(H.html_title(F.lit(HTML[0])), H.html_title(F.lit(HTML[0]), False)).first()
    assert tuple(text) == ("and&", "and&amp")
