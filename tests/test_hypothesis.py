"""Randomised checks of the null-safe arithmetic against a plain-Python statement of the rules."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarterdeck.functions import safe_divide, strict_greatest, strict_least

values = st.one_of(st.none(), st.just(0.0), st.floats(allow_nan=False, allow_infinity=False, width=64))


def py_safe_divide(a, b):
    if a is None or b is None or b == 0:
        return None
    try:
        q = a / b
    except OverflowError:
        return None
    return None if math.isinf(q) else q


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(values, values), min_size=1, max_size=40))
def test_safe_divide_rules(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r[0] for r in df.select(safe_divide("a", "b")).collect()]
    for (a, b), g in zip(rows, got):
        e = py_safe_divide(a, b)
        assert (g is None and e is None) or (g is not None and e is not None and (g == e or math.isclose(g, e)))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(values, values), min_size=1, max_size=40))
def test_strict_least_greatest_rules(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double")
    got = df.select(strict_least("a", "b").alias("l"), strict_greatest("a", "b").alias("g")).collect()
    for (a, b), r in zip(rows, got):
        if a is None or b is None:
            assert r.l is None and r.g is None
        else:
            assert r.l == min(a, b) and r.g == max(a, b)


@given(st.text(max_size=30))
def test_clean_name_is_idempotent_and_safe(name):
    import re

    from quarterdeck.functions import clean_name

    once = clean_name(name)
    assert clean_name(once) == once
    assert re.fullmatch(r"[A-Za-z0-9_]*", once)
    assert not once[:1].isdigit()
    assert len(once) in (len(name), len(name) + 1)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.permutations(["a", "b", "c", "d"]), st.integers(min_value=1, max_value=3))
def test_union_by_name_keeps_every_row_and_column(spark, order, split):
    from quarterdeck.operators.reshape import union_by_name

    left = spark.createDataFrame([tuple(range(split))], ", ".join(f"{c} int" for c in order[:split]))
    right = spark.createDataFrame([tuple(range(4 - split))], ", ".join(f"{c} int" for c in order[split:]))
    out = union_by_name(left, right)
    assert out.columns == list(order[:split]) + sorted(order[split:])
    assert out.count() == 2
