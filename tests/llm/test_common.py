import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import common as C

UP = str.maketrans(C.UPPER, C.LOWER)
text = st.one_of(st.none(), st.text(alphabet="aB é\t\n\r\x0b\x0c\x1c\u00a0ßZ", max_size=20))


@settings(max_examples=100, deadline=None)
@given(st.lists(text, max_size=6))
def test_words_match_the_pattern(texts):
    codes, offsets, words = C.split_words(pa.array(texts, pa.string()))
    names = words.to_pylist()
    got = [[names[c] for c in codes[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [re.findall(C.WORD, (t or "").translate(UP)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(text, max_size=6), st.integers(1, 4))
def test_shingles_are_distinct_sequences(texts, width):
    doc, key = C.shingle_keys(pa.array(texts, pa.string()), width)
    sets = []
    for t in texts:
        w = re.findall(C.WORD, (t or "").translate(UP))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()})
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(s) for s in sets]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert len(set(key[doc == i]) & set(key[doc == j])) == len(a & b)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1)), st.lists(st.integers(0, 10**12)))
def test_packing_round_trips(keys, counts):
    k = np.sort(np.array(keys, np.uint64))
    assert (C.unpack_keys(C.pack_keys(k)) == k).all()
    assert C.unpack_counts(C.pack_counts(np.array(counts, np.int64))).tolist() == counts


def test_components(llm_spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, C.components(llm_spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}
    assert C.components(llm_spark.createDataFrame([], "a long, b long")).count() == 0
