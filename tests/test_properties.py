"""Property tests against Python brute force on random small frames (NULL, NaN, -0.0, repeats)."""

import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from paritas.operators import parity as P
from paritas.operators import rowdiff as R
from paritas.operators.pair import TablePair

VAL = st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, float("nan")]))
ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)), VAL, st.one_of(st.none(), st.sampled_from(["a", "b", "a|b"])))
FRAME = st.lists(ROW, max_size=12)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    return v


def _key(row):
    return tuple(_norm(v) for v in row)


@SETTINGS
@given(a=FRAME, b=FRAME)
def test_multiset_diff_is_counter_difference(spark, a, b):
    ddl = "k int, x double, s string"
    p = TablePair(spark.createDataFrame(a, ddl), spark.createDataFrame(b, ddl))
    got = Counter()
    for r in R.multiset_diff(p).collect():
        got[(r.side,) + _key((r.k, r.x, r.s))] += r.n
    ca, cb = Counter(map(_key, a)), Counter(map(_key, b))
    want = Counter({("source",) + k: n for k, n in (ca - cb).items()}) + Counter({("target",) + k: n for k, n in (cb - ca).items()})
    assert got == want


@SETTINGS
@given(a=FRAME, b=FRAME)
def test_distinct_values_match_python_sets(spark, a, b):
    ddl = "k int, x double, s string"
    p = TablePair(spark.createDataFrame(a, ddl), spark.createDataFrame(b, ddl))
    got = {r.column_name: (r.source_distinct, r.target_distinct) for r in P.unique_value_parity(p).collect()}
    for i, c in enumerate(["k", "x", "s"]):
        assert got[c] == (len({_norm(r[i]) for r in a}), len({_norm(r[i]) for r in b}))
