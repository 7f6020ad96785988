"""Word and n-gram hashes, and the monotone sequences of the language model."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellwatch.llm import textvec
from cellwatch.llm.common import SPACE_WORD
from cellwatch.llm.lm_score import EliasFano, NONE, coded_counts, decoded_counts, quantised, token_hashes
from cellwatch.llm.near_dups import shingle_sets

TEXT = st.text(alphabet="aAbZ 0\t\n\x0b!é漢_", max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6), st.sampled_from([7, 1 << 22]))
def test_words_are_the_texts_words_whatever_the_block(texts, block):
    old, textvec.BLOCK = textvec.BLOCK, block
    try:
        w = textvec.Words(pa.array(texts, pa.string()), prefixes=(2,))
    finally:
        textvec.BLOCK = old
    words = [(t or "").encode().split() for t in texts]
    assert np.diff(w.row).tolist() == [len(x) for x in words]
    flat = [x for ws in words for x in ws]
    assert [w.raw[a:z].tobytes() for a, z in zip(w.start, w.end)] == flat
    by_word: dict = {}
    for h, x in zip(w.hash.tolist(), flat):
        assert by_word.setdefault(x.lower(), h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_words_may_hold_nul():
    texts = ["a\0b c", "\0", "a b\0 \0\0", "a b c"]
    for cased in (textvec.SPACED, textvec.SPACED_CASED):
        w = textvec.Words(pa.array(texts), cased)
        assert [w.raw[a:z].tobytes().decode() for a, z in zip(w.start, w.end)] == [
            x for t in texts for x in re.findall(SPACE_WORD, t)]
        assert len(set(w.hash.tolist())) == 7                       # a twice, the rest once, c twice
    assert np.diff(token_hashes(pa.array(texts))[1]).tolist() == [3, 2, 4, 4]
    shingles = list(shingle_sets(pa.array(["a\0b c d e f", "a b c d e f"])))
    assert [len(s) for s in shingles] == [1, 2]


def test_grams_depend_on_words_alone():
    h = np.array([1, 2, 3, 1, 2, 3], np.uint64)
    g = textvec.grams(h, 3)
    assert g[0] == g[3] and len(set(g.tolist())) == 3 and len(textvec.grams(h[:2], 3)) == 0


@pytest.mark.parametrize("n,top", [(0, 9), (1, 5), (300, 1 << 12), (2000, 1 << 40), (5000, 1 << 63)])
def test_elias_fano_finds_what_it_holds(n, top):
    rng = np.random.default_rng(n)
    v = np.unique(rng.integers(0, top, n, dtype=np.uint64))
    seq = EliasFano.build(v)
    asked = np.unique(np.r_[v, rng.integers(0, top, 400, dtype=np.uint64), NONE - np.uint64(1)])
    place = {int(x): i for i, x in enumerate(v)}
    assert seq.find(asked).tolist() == [place.get(int(x), -1) for x in asked]
    assert (seq.values() == v).all()


def test_codes_round_down_and_stay_close():
    c = np.array([1, 2, 32767, 32768, 10**6, 10**9])
    d = decoded_counts(coded_counts(c))
    assert (d <= c).all() and (d >= 0.997 * c).all()
    x = np.array([0.0, -0.1, -3.0])
    assert (-quantised(x).astype(float) / 4096 <= x).all()
