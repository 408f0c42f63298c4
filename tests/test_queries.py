"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from pyspark.errors import PythonException

from __spark_entry__ import entry, oracle_sql, queries
from pagemill.functions import html as html_module
from pagemill.plans.oracle import ORACLES
from pagemill.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = con.sql(ORACLES[name])
    assert comparable(df.columns, df.collect()) == comparable(relation.columns, relation.fetchall())


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 97
    assert sum(r.split == "train" for r in rows) == int(97 * 0.9)


def test_no_query_plans_a_cross_join(spark, plan):
    for name in ("frontier_next", "visit_gate", "resume_frontier", "seeded_order", "dedup_first_wins", "prep_summary"):
        text = plan(queries()[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_url_queries_do_not_read_html(spark, plan):
    for name in ("url_parts", "url_defrag", "path_pattern", "url_slug"):
        assert "ReadSchema: struct<page_id:bigint,url:string>" in plan(queries()[name](spark, SF_DIR)), name


def test_filters_reach_the_scan(spark, plan):
    text = plan(queries()["visit_gate"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(page_id), LessThan(page_id,25)]" in text


def test_python_runs_only_where_html_is_read(spark, plan):
    html = {"html_title", "html_text", "html_categories", "html_roundtrip", "extract_pages", "extract_reject",
            "extract_links", "page_outcomes", "outcome_counts", "href_filter", "resolve_links", "same_domain"}
    plain = {"strip_text", "collapse_newlines", "token_cap", "dedup_first_wins", "training_pairs", "chat_render",
             "chat_messages", "seeded_order", "resolve_relative", "page_upsert", "page_source", "resume_frontier"}
    for name in html | plain:
        assert plan(queries()[name](spark, SF_DIR)).count("ArrowEvalPython") == (name in html), name


@pytest.mark.parametrize("name", ["visit_gate", "same_domain"])
def test_queries_read_html_in_portions(spark, con, monkeypatch, name):
    """A portion a page: the rows are those of the SQL all the same."""
    monkeypatch.setattr(html_module, "PORTION", 1)
    rows = queries()[name](spark, SF_DIR)
    sql = con.sql(oracle_sql()[name])
    assert comparable(rows.columns, rows.collect()) == comparable(sql.columns, sql.fetchall())


@pytest.mark.parametrize("name", ["visit_gate", "same_domain"])
def test_queries_parse_a_portion_at_a_time(spark, monkeypatch, name):
    """However many pages Spark puts into a batch, the parser is given a portion of it; here that is a page."""
    parsed = html_module.parsed

    def one(pages, *content):
        assert len(pages) <= 1, f"{len(pages)} pages at a time"
        return parsed(pages, *content)

    monkeypatch.setattr(html_module, "parsed", one)
    with pytest.raises(PythonException, match="pages at a time"):
        queries()[name](spark, SF_DIR).collect()
    monkeypatch.setattr(html_module, "PORTION", 1)
    assert queries()[name](spark, SF_DIR).count() > 0
