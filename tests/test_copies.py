"""Queries against their SQL on keys and amounts that only larger copies of the tables have."""

import duckdb
import pytest

from siteweave.plans import catalogue, landed  # noqa: F401
from tests.test_queries import norm

BOXED = ("union_records", "read_feature_points", "read_feature_landings", "landings_of_several_files")


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Some customers, parts and suppliers whose places lie on either side of the date line or beyond it."""
    at, con = tmp_path_factory.mktemp("copies"), duckdb.connect()
    keys = "select unnest([1, 2, 3, 5, 8, 259_999, 260_001, 480_000, 480_003, 649_999, 650_001, 700_000, 700_001, 899_999])"
    con.execute(f"create view customer as select k::bigint c_custkey, 'Customer#' || k c_name, (k % 25)::int c_nationkey, [4516.95 + 37, 0.125, 1.005, 1e-3, -0.0, -0.001, -7.5, 'nan'::double][k % 8 + 1] c_acctbal from ({keys}) t(k)")
    con.execute(f"create view part as select k::bigint p_partkey, 'red ring' p_name from ({keys}) t(k)")
    con.execute(f"create view supplier as select k::bigint s_suppkey, 'Supplier#' || k s_name from ({keys}) t(k)")
    for t in ("customer", "part", "supplier"):
        con.execute(f"copy {t} to '{at}/{t}.parquet' (format parquet)")
    return str(at), con


@pytest.mark.parametrize("name", (*BOXED, "text_numbers"))
def test_large_keys(spark, tables, name):
    at, con = tables
    df, cur = catalogue.QUERIES[name](spark, at), con.execute(catalogue.SQL[name])
    names = [d[0] for d in cur.description]
    got = sorted(tuple(map(norm, r)) for r in df.select(*names).collect())
    assert got == sorted(tuple(map(norm, r)) for r in cur.fetchall()) and got
    if name in BOXED:
        assert len(got) < 14 * (3 if name == "union_records" else 1)  # what lies beyond the world is left out


def test_what_several_read_is_computed_once(spark):
    """The driver plans one report after the other, and numbered sites stand in a written table: what is left to read has no join."""
    for df in (catalogue.run_metrics(spark, "/root/testdata/sf0.001"), catalogue._numbered(spark, "/root/testdata/sf0.001")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan and "parquet" in plan


def test_pairs_of_a_report_are_dealt_over_all_tasks(spark):
    plan = catalogue.duplicates_report(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan  # its size doesn't follow from bytes


def test_members_are_computed_once_for_their_country(spark):
    """Only records and clusters are joined: the clusters' countries are a window over what is brought together anyway."""
    for df in (catalogue.sites(spark, "/root/testdata/sf0.001"), catalogue.member_rank(spark, "/root/testdata/sf0.001")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


@pytest.mark.parametrize("name", ("candidate_pairs", "same_source_pairs", "landing_gaps", "nearest_counterparts", "apply_never", "apply_always", "override_status", "review_items", "select_canonical", "merged_report", "review_report", "duplicates_report"))
def test_no_side_that_grows_is_sent_whole(spark, name):
    """Compressed files are small, their rows in the driver's memory aren't: records, pairs and clusters are merged whatever their size."""
    plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
