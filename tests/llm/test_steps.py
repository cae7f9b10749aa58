"""What operators share: sieves, counters told to workers, steps that go when they are used up."""

import os
from types import SimpleNamespace
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from conftest import rows
from curfew.llm import line_dedup, mixing, near_duplicates, queries, steps
from llm.conftest import SMALL, prose
from llm.test_groups import brute_lines
from pyspark.sql import functions as F


def test_sieve_passes_its_values_and_few_others(spark):
    steps.ship(spark)
    found = steps.sieve(spark.range(0, 3000, 3))
    passes = found.build(found.shared.value).has(np.arange(3000))
    assert passes[::3].all() and passes.sum() < 1000 + 300
    kept = {r.id for r in spark.range(3000).filter(steps.may_be_in(found, F.col("id"))).collect()}
    assert kept == set(np.flatnonzero(passes).tolist())
    none = steps.sieve(spark.range(0))
    assert not none.build(none.shared.value).has(np.arange(100)).any()
    found.free()


def test_rare_words_are_counted_without_moving_texts(docs_of, monkeypatch):
    """Words beyond the common ones are told by counters; even if all share four of them the lines are right."""
    monkeypatch.setattr(line_dedup, "COMMON_WORDS", 3)
    pairs = [(i, "\n".join([prose(7 * i, 9), prose(7 * (i // 2), 12), prose(1, 5 + i % 3)])) for i in range(40)]
    for bits, block in ((23, 12), (2, 1)):
        monkeypatch.setattr(line_dedup, "SLOT_BITS", bits)
        monkeypatch.setattr(line_dedup, "SLOT_BLOCK_BITS", block)
        assert sorted(rows(line_dedup.report(docs_of(*pairs))), key=repr) == brute_lines(pairs)


def test_buckets_of_two_are_not_opened(docs_of, monkeypatch):
    """Both texts of such a bucket have been compared, so no shingle of them is exchanged again."""
    seen, shared = [], near_duplicates.shared_weights
    monkeypatch.setattr(near_duplicates, "shared_weights", lambda texts, machine: seen.append(texts.count()) or shared(texts, machine))
    pairs = [(2 * k + j, prose(1000 * k, 60, "a") + " " + prose(1000 * k, 18, f"own{j}x")) for k in range(12) for j in (0, 1)]
    found = {r.doc_id: r.class_size for r in near_duplicates.report(docs_of(*pairs)).collect()}
    assert set(found.values()) == {1} and seen == [0]


def test_steps_of_mixing_go(spark, monkeypatch):
    """Of what is written only the last state stays."""
    folders, write = [], steps.written
    monkeypatch.setattr(steps, "written", lambda *a: folders.append((out := write(*a))._written_to) or out)
    known = mixing.domain_of_labels(queries.table(spark, SMALL, "labels"))
    state, _ = mixing.rates(queries.table(spark, SMALL, "documents"), known, {"clean": 1.0, "poor": 1.0})
    there = [f for f in folders if os.path.exists(urlparse(f).path)]
    assert state.count() > 0 and len(folders) > 3 and len(there) <= 2


def test_worker_keeps_only_what_its_task_uses(monkeypatch):
    """What earlier stages have built is dropped when a task builds something else."""
    task = SimpleNamespace(taskAttemptId=lambda: 1)
    monkeypatch.setattr(steps, "TaskContext", SimpleNamespace(get=lambda: task), raising=False)
    monkeypatch.setattr(steps.OnWorker, "kept", {})

    def one(data):
        return data

    def two(data):
        return data

    shared = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x)))
    first, second, third = steps.OnWorker(shared, "a", one), steps.OnWorker(shared, "b", two), steps.OnWorker(shared, "c", one)
    assert (first.get(), second.get(), first.get()) == ("a", "b", "a") and len(steps.OnWorker.kept) == 2
    task = SimpleNamespace(taskAttemptId=lambda: 2)
    assert third.get() == "c" and [k for k, *_ in steps.OnWorker.kept.values()] == [third.key]


def test_batches_are_small_within_a_step(spark):
    """Long texts come to the workers a few at a time, and the setting is as before after it."""
    long = spark.range(0, 64, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([len(b)])], names=["n"]) for b in batches)
    with steps.small_batches(spark):
        assert max(r.n for r in long.mapInArrow(sizes, "n bigint").collect()) <= 5
    assert spark.conf.get(steps.BATCH_BYTES, None) is None


def test_words_of_near_duplicates_take_one_worker(docs_of, monkeypatch):
    """Texts are sieved by the step that finds their words, not by a Python step before it in the same task."""
    plans, listed = [], near_duplicates.listed_words

    def seen(texts, *more):
        out = listed(texts, *more)
        plans.append(out._jdf.queryExecution().toString())
        return out

    monkeypatch.setattr(near_duplicates, "COMMON_WORDS", 1)
    monkeypatch.setattr(near_duplicates, "listed_words", seen)
    pairs = [(k, prose(1000 * (k // 2), 60)) for k in range(8)] + [(k, prose(1000 * k, 60) + f" own{k}") for k in range(4)]
    assert len(near_duplicates.report(docs_of(*pairs)).collect()) == 12
    assert plans and "MapInArrow" in plans[0] and "ArrowEvalPython" not in plans[0]


def test_places_of_hashes():
    draw = np.random.default_rng(5)
    for size in (0, 1, 2, 70, 5000):
        known = np.unique(draw.integers(0, 1 << 64, size, dtype=np.uint64))
        wanted = np.concatenate([draw.integers(0, 1 << 64, 500, dtype=np.uint64), known, np.array([0, (1 << 64) - 1], np.uint64)])
        there = {h: k for k, h in enumerate(known.tolist())}
        assert steps.Places(known).of(wanted).tolist() == [there.get(h, -1) for h in wanted.tolist()]


def test_words_of_a_line_by_rarity():
    """Counts decide, then whole hashes, also where the first bits of many are equal."""
    draw = np.random.default_rng(6)
    group, n = np.repeat(np.arange(300), 40), draw.integers(1, 4, 12_000)
    for hashed in (draw.integers(0, 1 << 64, 12_000, dtype=np.uint64), draw.integers(0, 1 << 42, 12_000, dtype=np.uint64)):
        order, right = line_dedup.by_rarity(group, n, hashed), np.lexsort((hashed, n, group))
        assert (hashed[order] == hashed[right]).all() and (n[order] == n[right]).all()


def test_lines_are_counted_where_they_are_found():
    """The step that finds the words of lines also says in how many lines each is; lines of under four words are not counted."""
    texts = pa.array(["a b c d a\na b c e", "x y z", "\n", "a b c d"])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, None]), pa.array([5, 6, 7, 8]), texts], names=["doc_id", "own", "text"])
    found = pa.Table.from_batches(line_dedup.line_sets(4)([batch]))
    sets, counts = found.filter(pc.is_null(found["bucket"])), found.filter(pc.is_valid(found["bucket"]))
    assert sets["doc_id"].to_pylist() == [1, 2, None]
    unpacked = lambda name, kind, rows: np.concatenate([line_dedup.unpacked(c, kind)[0] for c in rows[name].chunks])
    assert unpacked("line", np.int32, sets).tolist() == [0, 1, 0, 0] and unpacked("size", np.int32, sets).tolist() == [4, 4, 3, 4]
    same = unpacked("set", np.int64, sets)
    assert same[0] == same[3] and len(set(same.tolist())) == 3
    assert sorted(unpacked("n", np.int32, counts).tolist()) == [1, 2, 3, 3, 3]


def test_documents_are_numbered_once(monkeypatch):
    """Numbers rise with the lines over all batches, and a repeated document has none of its own."""
    monkeypatch.setattr(line_dedup.TaskContext, "get", classmethod(lambda cls: SimpleNamespace(partitionId=lambda: 3)))
    lines = [[0, 2], [1], [1], [0], [4]]
    rows = [(None, 9), (0, 9), (0, 9), (0, 10), (7, 1)]

    def batch(first, last):
        packed = lambda kind: line_dedup.packed(
            np.cumsum([0, *map(len, lines[first:last])]), np.array(sum(lines[first:last], []), kind))
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in rows[first:last]], pa.int64()), pa.array([o for _, o in rows[first:last]], pa.int64()),
            packed(np.int32), packed(np.int64), packed(np.int64), packed(np.int32)], names=["doc_id", "own", "line", "set", "again", "size"])

    for cut in range(1, 5):
        found = list(line_dedup.numbered([batch(0, cut), batch(0, 0), batch(cut, 5)]))
        base = [b - (3 << line_dedup.NUMBER_BITS) for f in found for b in f.column(2).to_pylist()]
        assert base == [0, 3, 5, 6]
        single = pa.Table.from_batches(line_dedup.single_sets([f.select(["base", "line", "set", "again", "size"]) for f in found]))
        assert [n - (3 << line_dedup.NUMBER_BITS) for n in single["number"].to_pylist()] == [0, 2, 4, 5, 10]


def test_numbers_by_document_over_batches():
    base, number = np.array([4, 4, 4, 4, 9, 12, 12]), np.arange(7)
    for a in range(8):
        for b in range(a, 8):
            cuts = [(0, a), (a, b), (b, 7)]
            batches = [pa.RecordBatch.from_arrays([pa.array(base[i:j]), pa.array(number[i:j])], names=["base", "number"]) for i, j in cuts]
            found = pa.Table.from_batches(line_dedup.by_document(batches))
            own = [np.frombuffer(n, np.int64).tolist() for n in found["numbers"].to_pylist()]
            assert found["base"].to_pylist() == [4, 9, 12] and own == [[0, 1, 2, 3], [4], [5, 6]]
