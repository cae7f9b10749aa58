"""Near-duplicate embeddings next to all pairs."""

import math
import sys

import numpy as np
import pytest
from conftest import rows
from curfew.llm import embedding_dedup
from pyspark.sql import types as T

TYPE = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("label", T.IntegerType()), T.StructField("key", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("ball", T.StringType()), T.StructField("sketch", T.StringType()),
])


def table(spark, items):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, "x", "x", "x", "x")
                                  for i, v, label in items], TYPE)


def plain(items):
    """All pairs of equal labels, in double precision."""
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in map(lambda x: x if x is None else float(x), v)):
            return None
        a = np.array(v, float)
        return a / np.linalg.norm(a) if a.any() else None

    units, links, parent = [unit(v) for _, v, _ in items], [0] * len(items), list(range(len(items)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for x in range(len(items)):
        for y in range(x):
            same = items[x][2] is not None and items[x][2] == items[y][2]
            if same and units[x] is not None and units[y] is not None and len(units[x]) == len(units[y]):
                if units[x] @ units[y] >= 0.93:
                    links[x] += 1
                    links[y] += 1
                    parent[top(x)] = top(y)
    least = {}
    for k, (i, _, _) in enumerate(items):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), sys.maxsize))
    out = [(i, links[k], least.get(top(k))) for k, (i, _, _) in enumerate(items)]
    return sorted([(i, n, c, i == c) for i, n, c in out], key=repr)


def report(df):
    found = embedding_dedup.report(df)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(rows(found), key=repr)


def clusters(draw, sizes, spread, length=48):
    out = []
    for label, size, apart in zip(range(len(sizes)), sizes, spread):
        centre = draw.normal(size=length)
        for _ in range(size):
            out.append((centre + apart * draw.normal(size=length), label % 3))
    return [(k, v.tolist(), label) for k, (v, label) in enumerate(out)]


@pytest.mark.parametrize("block", [embedding_dedup.BLOCK, 8])
def test_against_all_pairs(spark, monkeypatch, block):
    """Close, loose and lone vectors, copies of some, in whole buckets and in many blocks."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    items = clusters(np.random.default_rng(5), [60, 60, 40, 40, *[1] * 40], [0.05, 0.2, 0.25, 0.35, *[1] * 40])
    items += [(1000 + i, v, label) for i, v, label in items[::7]]
    want = plain(items)
    got = report(table(spark, items))
    assert [x[0] for x in got] == [x[0] for x in want]
    assert sum(x[1] for x in got) >= 0.999 * sum(x[1] for x in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g == w for g, w in zip(got, want)) >= 0.99 * len(want)


def test_a_close_group_is_not_compared(spark, monkeypatch):
    """Nodes of one centre are counted without a comparison."""
    def refuse(machine):
        def give(batches):
            for table, _ in embedding_dedup.cut(batches, 10):
                raise AssertionError("compared")
                yield table
        return give

    monkeypatch.setattr(embedding_dedup, "linked", refuse)
    items = clusters(np.random.default_rng(6), [150], [0.03])
    assert report(table(spark, items)) == plain(items)


def test_odd_rows(spark):
    """Null and equal ids, null labels, unusable vectors, other lengths, copies, scaled, tiny and huge ones."""
    v = [1.0, 2.0, 3.0, 4.0]
    items = [
        (None, v, 1), (None, v, 1), (5, v, 1), (5, v, 1), (4, [2.0, 4.0, 6.0, 8.0], 1), (6, v, None), (7, v, 2), (8, None, 1), (9, [], 1),
        (10, [0.0] * 4, 1), (11, [1.0, None, 3.0, 4.0], 1), (12, [1.0, float("nan"), 3.0, 4.0], 1), (13, [1.0, float("inf"), 3.0, 4.0], 1),
        (14, [1.0, 2.0, 3.0], 1), (15, [1e-200, 2e-200, 3e-200, 4e-200], 1), (16, [1e200, 2e200, 3e200, 4e200], 1),
        (17, [-1.0, -2.0, -3.0, -4.0], 1), (None, None, None), (None, [1.0, -1.0, 1.0, -1.0], 9), (1 << 40, [3.0, 2.0, 1.0], 1),
    ]
    want = [(i, n, c, k if i is not None or c is not None else True) for i, n, c, k in (
        (i, n, c, i == c) for i, n, c, _ in _scaled_plain(items))]
    assert report(table(spark, items)) == sorted(want, key=repr)


def _scaled_plain(items):
    """``plain`` with components scaled first, as tiny and huge squares are lost in it."""
    def scaled(v):
        known = [abs(x) for x in v or [] if x is not None and math.isfinite(x)]
        top = max(known, default=0)
        return [x if x is None else x / top for x in v] if v and top and len(known) == len(v) else v

    return plain([(i, scaled(v), label) for i, v, label in items])


def test_empty_table(spark):
    assert report(table(spark, [])) == []


def test_layout_keeps_recall():
    share = 1 - embedding_dedup.ANGLE / math.pi
    for largest in (0, 1, 500, 10**6, 10**9):
        bits, tables = embedding_dedup.layout(largest)
        assert (1 - share**bits) ** tables <= embedding_dedup.MISS and bits <= 64
