"""Operators against brute-force Python on random small inputs (hypothesis)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cyclemart.operators.dedup import keep_first
from cyclemart.operators.merge import ACTION_COL, scd1_merge
from cyclemart.operators.quality import evaluate
from tests.conftest import sized

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"]))
vals = st.one_of(st.none(), st.integers(-3, 3))


@SETTINGS
@given(target=st.lists(st.tuples(keys, vals), max_size=8),
       source=st.lists(st.tuples(keys, vals), max_size=6),
       strategy=st.sampled_from(["full", "broadcast_source"]))
def test_scd1_merge_matches_brute_force(spark, target, source, strategy):
    # Source keys unique (the merge's precondition); target as given (may repeat keys).
    seen, src = set(), []
    for k, v in source:
        if k is None or k not in seen:
            src.append((k, v))
            seen.add(k)
    t = sized(spark, [(k, v, "t") for k, v in target], "k string, v int, origin string")
    s = sized(spark, [(k, v) for k, v in src], "k string, v int")
    got = sorted(((r.k, r.v, r.origin, r[ACTION_COL]) for r in
                  scd1_merge(t, s, ["k"], with_action=True, on_duplicate="trust",
                             strategy=strategy).collect()), key=repr)
    expected = []
    src_by_key = {k: v for k, v in src if k is not None}
    for k, v in target:
        if k is not None and k in src_by_key:
            expected.append((k, src_by_key[k], "t", "updated"))
        else:
            expected.append((k, v, "t", "kept"))
    target_keys = {k for k, _ in target if k is not None}
    for k, v in src:
        if k is None or k not in target_keys:
            expected.append((k, v, None, "inserted"))
    assert got == sorted(expected, key=repr)


@SETTINGS
@given(rows=st.lists(st.tuples(keys, vals, st.integers(0, 1000)), max_size=12),
       ascending=st.booleans())
def test_keep_first_matches_brute_force(spark, rows, ascending):
    df = sized(spark, [(k, v, i) for k, v, i in rows], "k string, v int, i int")
    got = sorted(((r.k, r.v, r.i) for r in keep_first(df, ["k"], "v", ascending=ascending,
                                                         tie_breakers=["i"]).collect()), key=repr)
    best = {}
    for k, v, i in rows:
        # NULL first when ascending, last when descending; ties by i in the same direction.
        rank = ((v is not None), v if v is not None else 0, i)
        if not ascending:
            rank = ((v is not None), -(v if v is not None else 0), -i)
            rank = (not rank[0],) + rank[1:]
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, v, i))
    assert got == sorted((x for _, x in best.values()), key=repr)


@SETTINGS
@given(rows=st.lists(st.tuples(keys, st.one_of(st.none(), st.floats(-5, 5), st.just(float("nan")))),
                     max_size=12),
       min_rows=st.integers(0, 6))
def test_quality_rules_match_brute_force(spark, rows, min_rows):
    df = sized(spark, rows, "k string, x double")
    rules = {"not_null": ["k"], "no_duplicates": ["k"], "positive_values": ["x"],
             "allowed_values": {"k": ["a", "b"]}, "min_row_count": min_rows}
    got = {r.rule: r.failing_count for r in evaluate(df, "t", rules).collect()}
    xs = [x for _, x in rows]
    expected = {
        "not_null": sum(k is None for k, _ in rows),
        "no_duplicates": len(rows) - len({k for k, _ in rows}),
        "positive_values": sum(x is not None and not math.isnan(x) and x <= 0 for x in xs),
        "allowed_values": sum(k is not None and k not in ("a", "b") for k, _ in rows),
        "min_row_count": max(min_rows - len(rows), 0),
    }
    assert got == expected
