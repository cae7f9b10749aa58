"""The trie of conversation prefixes next to a dictionary of all prefixes."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from conftest import rows
from curfew.llm import prefix_trie, queries
from llm.conftest import MEDIUM, SMALL
from pyspark.sql import types as T

TYPE = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("part", T.StringType()), T.StructField("node", T.StringType()),
])
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(turns):
    """All prefixes of all rebuilt conversations in a dictionary."""
    original = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            original[conv].append((turn is not None, turn or 0, tie, role, text))
    for conv in original:
        original[conv] = [t[3:] for t in sorted(original[conv])]
    members = defaultdict(list)
    ends = defaultdict(list)
    for conv, own in original.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        whole = tuple(original.get(base, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(conv)
        ends[whole].append(conv)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, convs in members.items():
        gain = (len(convs) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += gain
    out = [(min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, convs in members.items()]
    return sorted(out, key=repr)


def report(df):
    found = prefix_trie.report(df)
    assert found.columns == COLUMNS
    return sorted(rows(found), key=repr)


def table(spark, turns):
    return spark.createDataFrame([(*t, "x", "x") for t in turns], TYPE)


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_whole_tables(spark, folder):
    turns = queries.table(spark, folder, "conversations")
    assert report(turns) == plain(rows(turns.select("conv_id", "turn", "role", "text")))


@pytest.mark.parametrize("chunk", [prefix_trie.CHUNK, 3])
def test_deep_wide_and_equal(spark, monkeypatch, chunk):
    """A long conversation, copies of it, one first turn for many, over more ranges than keys."""
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    turns = [(1, k, "user", f"turn {k % 5}") for k in range(150)]
    turns += [(300 + c, k, "user", f"turn {k}") for c in range(40) for k in range(c % 4 + 1)]
    turns += [(c, k, "user", f"same {k}") for c in range(1000, 1060) for k in range(7)]
    turns += [(c, 0, "user", f"own {c}") for c in range(2000, 2040)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert report(table(spark, turns)) == plain(turns)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_rows(spark):
    """Null ids, turns, roles and texts, equal turns, repeated rows, turnless and negative conversations, gaps of
    the shared beginning, very long texts."""
    turns = [
        (None, 0, "user", "x"), (None, None, None, None), (100, None, None, None), (100, 0, "user", "b"), (100, 0, "user", "a"),
        (100, 0, "user", "a"), (100, 9, "assistant", "é😀" * 5000), (101, 0, "user", "q"), (102, 5, None, "r"), (102, 5, "user", None),
        (103, 1, "use", "rx"), (104, 1, "user", "x"), (-5, 0, "user", "n"), (-105, 0, "user", "n"), (-100, 1, "user", "m"), (7, 0, "user", ""),
        (250, 3, "user", "only"), (1 << 50, 1, "user", "far"),
    ] + [(c, k, "user", "t") for c in range(700, 730) for k in range(c % 3)]
    assert report(table(spark, turns)) == plain(turns)


def test_empty_tables(spark):
    assert report(table(spark, [])) == []
    assert report(table(spark, [(None, 1, "user", "x")])) == []
    assert report(table(spark, [(105, None, None, None)])) == plain([(105, None, None, None)])
