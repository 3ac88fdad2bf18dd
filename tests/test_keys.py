import random
from collections import defaultdict
from math import floor

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from telar.operators import keys

SCHEMA = "doc_id string, chunk_id string, n long, k string, salt int, v double"


def frame(spark, rows):
    return spark.createDataFrame([(d, c, n, "clash", 1, 0.5) for d, c, n in rows], SCHEMA)


def brute(rows, probs):
    by, null = defaultdict(dict), defaultdict(set)
    for d, c, n in rows:
        if d is not None and c is not None:
            old = by[d].get(c)
            by[d][c] = n if old is None else old if n is None else max(old, n)
    out = {}
    for d, cs in by.items():
        v = sorted(x for x in cs.values() if x is not None)
        q = [v[max(1, len(v) - floor(len(v) - p * len(v))) - 1] if v else None for p in probs]
        out[d] = (len(v), len(cs) - len(v), *q)
    return out


def got(spark, rows, probs=(0.5, 0.9, 0.99), **kw):
    r = keys.key_quantiles(frame(spark, rows), "doc_id", "n", probs, distinct="chunk_id", **kw).collect()
    return {x["doc_id"]: (x["n"], x["n_null"], *[x[f"q_{i:02d}"] for i in range(len(probs))]) for x in r}


def test_hot_key_and_long_range_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [("hot", f"h{i}", rng.choice([rng.randrange(-(10**15), 10**15), rng.randrange(5)])) for i in range(3000)]
    rows += [(f"d{i % 50}", f"c{i}", rng.randrange(300)) for i in range(500)]
    assert got(spark, rows, bins=4) == brute(rows, (0.5, 0.9, 0.99))


def test_nulls_ties_repeats(spark):
    rows = [("a", "1", 5), ("a", "1", 5), ("a", "2", 5), ("a", "3", None), (None, "4", 9), ("b", None, 7), ("c", "5", None), ("d", "6", 3), ("d", "6", None), ("d", "6", 8)]
    assert got(spark, rows) == brute(rows, (0.5, 0.9, 0.99))
    assert got(spark, rows)["c"] == (0, 1, None, None, None)


def test_empty(spark):
    assert got(spark, []) == {}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([None, *map(str, range(9))]), st.one_of(st.none(), st.integers(-(2**62), 2**62))), max_size=30))
def test_any_rows(spark, rows):
    assert got(spark, rows) == brute(rows, (0.5, 0.9, 0.99))


def test_hot_keys(spark):
    rows = [("big", f"b{i}", 1) for i in range(30)] + [("big", "b0", 1)] + [(f"s{i}", f"c{i}", 1) for i in range(60)] + [(None, f"n{i}", 1) for i in range(10)]
    out = {r["doc_id"] for r in keys.hot_keys(frame(spark, rows), "doc_id", "chunk_id", "n", 0.3).collect()}
    assert out == {"big"}
    assert {r["doc_id"] for r in keys.hot_keys(frame(spark, rows), "doc_id", "chunk_id", "n", 0.31).collect()} == set()
