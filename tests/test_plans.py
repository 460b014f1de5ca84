"""Plan-shape checks: no Python UDFs, no pair-producing joins, pruned scans."""

import pytest

from ledgerline.plans import queries as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(Q.QUERIES))
def test_no_udf_no_cartesian(spark, sf_dir, key):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        Q.QUERIES[key](spark, sf_dir).explain("formatted")
    plan = buf.getvalue()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{key}: {bad} in plan"


def test_scan_reads_only_needed_columns(spark, sf_dir):
    df = Q.QUERIES["clean_loans"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # loans come from orders: only the five used columns are read
    assert "o_totalprice" not in plan and "o_orderstatus" not in plan


def test_imputation_is_a_scalar_subquery(spark, sf_dir):
    df = Q.QUERIES["emp_length_imputed"](spark, sf_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan.lower() or "ScalarSubquery" in plan
    assert "Join Cross" not in plan


def _scans(df):
    """File scans of the plan that ran."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return sum("FileScan" in line and "Reused" not in line for line in final.splitlines())


@pytest.mark.parametrize("key,most", [("credit_score", 8), ("customers_bad_rows", 3), ("row_counts", 14)])
def test_inputs_are_read_few_times(spark, sf_dir, key, most):
    assert _scans(Q.QUERIES[key](spark, sf_dir)) <= most


def test_required_field_checks_reach_the_csv_scan(spark, sf_dir):
    from ledgerline.operators import clean
    from ledgerline.session import scratch_path
    from ledgerline.sources import files
    from ledgerline.sources.fixtures import LendingInputs
    path = scratch_path(spark, "loans_csv")
    files.write_csv(LendingInputs(spark, sf_dir).loans(ingest=False), path, keep_whitespace=True)
    df = clean.clean_loans(files.read_loans(spark, path))
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    for c in ("loan_amount", "funded_amount", "loan_status", "loan_title"):
        assert f"IsNotNull({c})" in plan
