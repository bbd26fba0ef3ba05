"""Every registered query runs, and equals its SQL where there is one."""

import pytest

import oracle
from corpusmill.plans import catalogue


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n in catalogue.ORACLES])
def test_equals_sql(spark, sf_dir, name):
    oracle.check(spark, sf_dir, catalogue.QUERIES[name], catalogue.ORACLES[name])


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n not in catalogue.ORACLES])
def test_runs(spark, sf_dir, name):
    assert catalogue.QUERIES[name](spark, sf_dir).count() > 0


def test_article_debloat_keeps_references(spark, tmp_path):
    page = '<html><head><title>a &quot;t&quot; &gt;</title><style>p{}</style></head><body><article><h1>a</h1><p>token = &quot;1&quot; &copy; &amp;lt; b > c &lt;d&gt; &amp e "f"</p></article></body></html>'
    spark.createDataFrame([(1, page), (2, page), (7, page)], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    oracle.check(spark, str(tmp_path), catalogue.QUERIES["article_debloat"], catalogue.ORACLES["article_debloat"])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
