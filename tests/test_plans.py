"""The plans that matter at scale: nothing compared with everything, no whole table in one task, filters and columns at the scan."""

import re

import pytest

from linefold.plans import catalogue

SF = "/root/testdata/sf0.001"
#: Queries that run jobs while they are built.
EAGER = ("str", "snk", "ext", "grd", "jon13", "jon14", "jon15", "jon16", "mtc7", "agg24", "set8")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in catalogue.QUERIES if not n.startswith(EAGER)))
def test_no_cross_join_and_no_single_task_window(spark, name):
    plan = plan_of(catalogue.QUERIES[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search(r"Window .*\n.*Sort .*\n.*Exchange SinglePartition", plan)


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(catalogue.QUERIES["flt13_low_confidence"](spark, SF))
    assert "LessThan(value,0.6)" in plan and "ReadSchema: struct<event_id:bigint,value:double>" in plan
    plan = plan_of(catalogue.QUERIES["prj16_page_range"](spark, SF))
    assert "PushedFilters: [Or(" in plan
    plan = plan_of(catalogue.QUERIES["agg2_crosstab"](spark, SF))
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in plan


def test_relational_queries_stay_in_the_jvm(spark):
    python = [n for n in catalogue.QUERIES if not n.startswith(EAGER) and re.search("Python|Pandas|Arrow", plan_of(catalogue.QUERIES[n](spark, SF)))]
    # a search for many items at once; choices that depend on earlier ones; packages and their XML
    assert set(python) <= {
        "jon6_missed",
        "flt16_negative_blocks",
        "flt6_spaced_picks",
        "jon20_kept_first",
        "lint_package_checks",
        "mtc1_aligned",
        "mtc1_ordered_pairs",
        "mtc2_rescued",
        "mtc3_overlap",
        "mtc5_first_kept",
        "mtc6_chain",
        "mtc8_blobs",
        "src14_package_parts",
        "src8_package_kinds",
        "udf1_judged",
        "udf2_refined_boundaries",
        "win10_repaired_numbers",
    }
