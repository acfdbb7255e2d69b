"""Plan shape: no single-partition exchange (un-partitioned window / global sort into one task;
global aggregates, whose final step merges one partial row per partition, are not listed)
and no row-at-a-time Python UDF in the default query paths."""

import pytest

SF = "/root/testdata/sf0.001"

NAMES = ["exact_split", "kfold_assign", "global_rank", "metrics_by_group", "ks_test", "psi",
         "ecdf_two_sample", "split_valid_rejected", "enrich_requests",
         "panel_upsert", "category_share_compare", "half_split", "outcome_counts"]


@pytest.fixture(scope="module")
def catalog():
    import __spark_entry__ as E

    return E.queries()


@pytest.mark.parametrize("name", NAMES)
def test_no_single_partition_or_python_udf(spark, catalog, name):
    df = catalog[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan, plan
    assert "BatchEvalPython" not in plan, plan


def test_panel_pushes_columns_to_scan(spark):
    from domus.sources.panel import panel

    plan = panel(spark, SF).select("uid", "price_pln")._jdf.queryExecution().executedPlan().toString()
    assert "l_discount" not in plan  # pruned: the panel never reads lineitem's discount
