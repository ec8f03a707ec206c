"""Every registered query against its SQL on the smallest tables, and what the plans must not hold."""

import contextlib
import io
import math
from pathlib import Path

import pytest

import __spark_entry__ as contract
from bidlines.catalog import CHECKS, QUERIES
from bidlines.catalog.items import LINE_KEYS, line_notices
from bidlines.catalog.registry import Tables
from bidlines.operators.items import parse_notice_items

SF = Path("/root/testdata/sf0.001")
WRITING = ("notice_scan", "attachment_refs", "file_index", "batch_run", "incremental_run", "checkpoint_read", "reset_run", "rescue_run", "replayed_run", "void_checkpoint", "ordered_export")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        return v

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def plan_of(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_contract():
    assert contract.queries().keys() >= QUERIES.keys() == CHECKS.keys() <= contract.oracle_sql().keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["l_orderkey", "item", "objeto", "quantidade", "unidade_fornecimento"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    got = comparable(df.columns, df.collect())
    cursor = duck.execute(CHECKS[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == comparable(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(WRITING)))
def test_plan_pairs_nothing_and_runs_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, str(SF)))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def test_notice_parser_does_not_shuffle(spark):
    t = Tables(spark, str(SF))
    texts = line_notices(t)
    before, after = plan_of(texts), plan_of(parse_notice_items(texts, LINE_KEYS))
    assert before.count("Exchange") == after.count("Exchange")
    assert after.count("split(") == 1


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(QUERIES["tier_coverage"](spark, str(SF)))
    assert "o_totalprice" not in plan and "l_extendedprice" not in plan
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,A)" in plan.replace("In(", "")
