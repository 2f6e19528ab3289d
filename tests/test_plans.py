"""Physical-plan shape checks for the scale properties the README claims."""

import re

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_knn_and_nb_plans_have_no_pair_joins(spark):
    for name in ("knn_predict_en", "nb_predict"):
        plan = _plan(spark, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_top_n_per_group_limits_before_the_shuffle(spark):
    for name in ("feed_first_n", "events_newest_page"):
        plan = _plan(spark, name)
        tree = plan.split("\n\n")[0]
        # a partial WindowGroupLimit sits below the exchange feeding the window
        assert re.search(r"WindowGroupLimit[^\n]*\n(?:[^\n]*\n)*?[^\n]*Exchange[^\n]*\n(?:[^\n]*\n)*?[^\n]*WindowGroupLimit",
                         tree), name


def test_source_predicates_reach_the_scan(spark):
    plan = _plan(spark, "feed_source_filter")
    assert "EqualTo(lang,en)" in plan and "In(source, [src1,src3])" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "term_counts")
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all("n_chars" not in s and "source" not in s for s in schemas)
