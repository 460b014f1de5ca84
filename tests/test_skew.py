"""skew_join returns exactly the plain join's rows, for every join type."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators.skew import ROWS_PER_TASK_CONF, hot_keys, key_row_counts, rows_per_task, skew_join
from ledgerline.plans import queries as Q


@pytest.fixture
def limit(spark):
    """Sets the rows per task for one test."""
    def put(n):
        spark.conf.set(ROWS_PER_TASK_CONF, str(n))
    yield put
    spark.conf.unset(ROWS_PER_TASK_CONF)


@pytest.fixture(scope="module")
def sides(spark):
    big = ([("hot", i) for i in range(400)] + [("hot", 7)] * 50      # hot key incl. identical copies
           + [(f"k{i % 60}", i) for i in range(300)] + [(None, i) for i in range(20)])
    small = [("hot", "h")] + [(f"k{i}", f"s{i}") for i in range(0, 60, 2)] + [("k2", "dup"), (None, "n")]
    return (spark.createDataFrame(big, "key string, v int").repartition(4),
            spark.createDataFrame(small, "key string, w string"))


def test_hot_keys_do_not_depend_on_the_table_size(spark, sides):
    counts = key_row_counts(sides[0], "key")
    assert [tuple(r) for r in hot_keys(counts, "key", 100).collect()] == [("hot", 5)]
    assert hot_keys(counts, "key", 1000).count() == 0


@pytest.mark.parametrize("n", [1, 3, 100, 10_000])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_matches_plain_join(spark, sides, limit, how, n):
    limit(n)
    big, small = sides
    want = Counter(map(tuple, big.join(small, "key", how).collect()))
    got_df = skew_join(big, small, "key", how)
    assert got_df.columns == big.join(small, "key", how).columns
    assert Counter(map(tuple, got_df.collect())) == want


def test_bad_setting_raises(spark, sides, limit):
    limit("many")
    with pytest.raises(ValueError):
        rows_per_task(sides[0])
    limit(0)
    with pytest.raises(ValueError):
        rows_per_task(sides[0])


_keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(big=st.lists(_keys, min_size=1, max_size=60), small=st.lists(_keys, max_size=8),
       how=st.sampled_from(["inner", "left", "left_semi", "left_anti"]), n=st.integers(1, 12))
def test_property_equals_plain_join(spark, limit, big, small, how, n):
    limit(n)
    b = spark.createDataFrame([(k, i) for i, k in enumerate(big)], "key string, v int")
    s = spark.createDataFrame([(k, f"w{i}") for i, k in enumerate(small)], "key string, w string")
    want = Counter(map(tuple, b.join(s, "key", how).collect()))
    assert Counter(map(tuple, skew_join(b, s, "key", how).collect())) == want


@pytest.mark.parametrize("key", ["credit_score", "credit_score_per_loan", "loan_history_points", "credit_limit_points",
                                 "customers_loan_view", "customers_loan_table", "customers_bad_rows", "customers_unique_rows",
                                 "delinquencies_bad_rows"])
def test_queries_are_the_same_with_salts_forced(spark, sf_dir, limit, key):
    plain = Counter(map(repr, Q.QUERIES[key](spark, sf_dir).collect()))
    limit(2)
    Q._PLANS.clear()
    try:
        assert Counter(map(repr, Q.QUERIES[key](spark, sf_dir).collect())) == plain
    finally:
        Q._PLANS.clear()
