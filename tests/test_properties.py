"""Property tests against brute force on random inputs."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators.quality import split_unique

_keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e", "f"]))
_fixture = [HealthCheck.function_scoped_fixture]


@settings(max_examples=8, deadline=None, suppress_health_check=_fixture)
@given(keys=st.lists(_keys, min_size=1, max_size=80))
def test_split_matches_brute_force(spark, keys):
    rows = [(k, i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, v int")
    n = Counter(k for k in keys if k is not None)
    want_clean = Counter(r for r in rows if r[0] is not None and n[r[0]] == 1)
    want_bad = Counter(r for r in rows if r[0] is not None and n[r[0]] > 1)
    for split in (split_unique(df, "k"), split_unique(df, "k", lambda d: d.checkpoint())):
        assert Counter(map(tuple, split.clean.collect())) == want_clean
        assert Counter(map(tuple, split.bad.collect())) == want_bad
