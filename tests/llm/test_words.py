"""Words and hashes in arrays next to Python's own."""

import numpy as np
import pyarrow as pa
from curfew.llm import range_coder, steps, substring_dedup, words
from hypothesis import given, settings
from hypothesis import strategies as st

TEXTS = st.lists(st.one_of(st.none(), st.text("ab é\n\t\x0b\x85\u00a0", max_size=30)), max_size=20)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_and_windows(texts, limit):
    data, offsets = steps.text_buffers(pa.array(texts, pa.string()))
    known, seen = {}, 0
    for first, last in steps.pieces(offsets, limit):
        part, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        found = words.find(part, cuts)
        hashed = words.hashes(part, found)
        raw = part.tobytes()
        all_words = [raw[a:b] for a, b in zip(found.start, found.end, strict=True)]
        for k in range(first, last):
            own = all_words[found.first[k - first] : found.first[k - first + 1]]
            assert own == (texts[k] or "").encode().split()
        for length in (1, 3, 9):
            for k, value in enumerate(words.windows(hashed, length)):
                assert known.setdefault(tuple(all_words[k : k + length]), value) == value
        seen = last
    assert seen == len(texts)
    assert len(set(known.values())) == len(known)


def test_slices_and_wide_columns():
    texts = pa.array(["a b", None, "", "c"], pa.large_string())
    data, offsets = steps.text_buffers(texts.slice(1))
    assert data.tobytes() == b"c" and offsets.tolist() == [0, 0, 0, 1]


def test_cover_holds_every_difference():
    period, cover = substring_dedup.PERIOD, substring_dedup.COVER
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))
    assert substring_dedup.ANCHOR + period - 1 <= substring_dedup.WINDOW


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 60_000), max_size=60), st.integers(0, 60))
def test_range_coder_round_trip(ids, times):
    ids = np.array(ids * times, np.int64)
    table, blocks = range_coder.encode(ids)
    assert np.array_equal(range_coder.decode(table, blocks, len(ids)), ids)


def test_blocks_stand_alone_and_shrink():
    ids = np.random.default_rng(0).zipf(1.3, 5000) % 40_000
    table, blocks = range_coder.encode(ids)
    assert len(blocks) == 5 and len(table) + sum(map(len, blocks)) < 4 * len(ids) / 1.5
    second = range_coder.decode(table, blocks[1:2], range_coder.BLOCK)
    assert np.array_equal(second, ids[range_coder.BLOCK : 2 * range_coder.BLOCK])
