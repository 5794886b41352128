"""Property tests: upsert and keep-last against plain-Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabulon.operators.merge import MergeCardinalityError, upsert
from tabulon.operators.quality import keep_last

KEYS = st.one_of(st.none(), st.integers(0, 6))
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 99)), max_size=12)
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def model_merge(target, source):
    counts = {}
    for k, _ in source:
        if k is not None:
            counts[k] = counts.get(k, 0) + 1
    target_keys = {k for k, _ in target if k is not None}
    if any(n > 1 and k in target_keys for k, n in counts.items()):
        raise MergeCardinalityError("model")
    source_keys = {k for k, _ in source if k is not None}
    kept = [r for r in target if r[0] is None or r[0] not in source_keys]
    return sorted(kept + list(source), key=repr)


@SETTINGS
@given(target=ROWS, source=ROWS)
def test_upsert_matches_model(spark, target, source):
    t = spark.createDataFrame(target, "k bigint, v bigint")
    s = spark.createDataFrame(source, "k bigint, v bigint")
    try:
        want = model_merge(target, source)
    except MergeCardinalityError:
        try:
            upsert(t, s, ["k"]).collect()
        except MergeCardinalityError:
            return
        raise AssertionError("expected a cardinality error")
    got = sorted((tuple(r) for r in upsert(t, s, ["k"]).collect()), key=repr)
    assert got == want


@SETTINGS
@given(rows=st.lists(KEYS, max_size=30))
def test_keep_last_matches_model(spark, rows):
    data = [(k, i) for i, k in enumerate(rows)]
    df = spark.createDataFrame(data, "k bigint, pos bigint")
    last = {}
    for k, i in data:
        last[k] = i
    got = sorted(r.pos for r in keep_last(df, ["k"], ["pos"]).collect())
    assert got == sorted(last.values())
    sql_last = sorted([i for k, i in data if k is None] + [i for k, i in last.items() if k is not None])
    got_sql = sorted(r.pos for r in keep_last(df, ["k"], ["pos"], nulls_equal=False).collect())
    assert got_sql == sorted(sql_last)
