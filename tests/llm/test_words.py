import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import words as w

TEXT = st.lists(st.none() | st.text(alphabet="ab é\n\t.Z9", max_size=30), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXT, st.integers(1, 4))
def test_words_and_grams_agree_with_a_regular_expression(texts, n):
    found = []
    for row, data, offsets in w.slices(pa.array(texts, pa.string())):
        own = w.words_of(data, offsets)
        plain = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts[row : row + len(offsets) - 1]]
        flat = [x for words in plain for x in words]
        assert [data[a:b].tobytes().decode() for a, b in zip(own.start, own.stop, strict=True)] == flat
        assert own.count.tolist() == [len(x) for x in plain]
        grams = [tuple(x[i : i + n]) for x in plain for i in range(len(x) - n + 1)]
        at, value = w.grams(own, n)
        assert len(at) == len(grams)
        found += list(zip(grams, value.tolist(), strict=True))
    assert len(set(found)) == len({g for g, _ in found}) == len({h for _, h in found})


def test_slices_cover_all_rows_and_skip_none():
    texts = ["x" * (w.SLICE_BYTES // 2), None, "y z", "a" * (3 * w.SLICE_BYTES), "", "b"]
    parts = list(w.slices(pa.array(texts)))
    assert sum(len(offsets) - 1 for _, _, offsets in parts) == len(texts)
    assert b"".join(data.tobytes() for _, data, _ in parts).decode() == "".join(t or "" for t in texts)
    assert list(w.slices(pa.array([], pa.string()))) == []


def test_long_words_hash_alike_wherever_they_stand():
    long = "q" * (2 * w.SLICE_BYTES)
    hashes = []
    for text in (long, "x " + long, "x yy zzz " + long):
        for _, data, offsets in w.slices(pa.array([text])):
            hashes.append(int(w.words_of(data, offsets).hash[-1]))
    assert len(set(hashes)) == 1


def test_window_minimum():
    keys = np.array([5, 3, 8, 1, 9, 9, 2], dtype=np.uint64)
    for width in range(1, 8):
        assert w.window_minimum(keys, width).tolist() == [min(keys[i : i + width]) for i in range(len(keys) - width + 1)]
    assert not len(w.window_minimum(keys, 8))
