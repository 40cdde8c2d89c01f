"""The methods themselves, without Spark."""

import random

import numpy as np
from hypothesis import given, settings, strategies as st

from tidemark.llm import bpe, language, setsketch, suffix_dedup, toxicity
from tidemark.llm.common import tokenizer

ALPHABET = st.sampled_from(list("ab I'lmtvsre19  \n\t \x1cé漢🙂!?-"))


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=120).map("".join), st.integers(1, 9))
def test_tree_reduction_equals_the_library(text, leaf):
    tool = bpe.codec(*tokenizer(), leaf)
    assert tool.encode(text) == tool._encode(text)
    assert tool.decode(tool.encode(text)) == text.encode()


def test_long_runs_are_joined():
    tool = bpe.codec(*tokenizer(), 16)
    for text in ("a" * 3000, " " * 3000 + "x", "1" * 999 + " " * 999, "'l" * 500 + "l"):
        assert tool.encode(text) == tool._encode(text)


def test_loser_tree_merges_with_common_prefixes():
    draw = random.Random(3)
    rows = [(bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 12))), b"l%d" % i, (i, 0, 0)) for i in range(500)]
    parts = [sorted(rows[i::7]) for i in range(7)]
    out = list(suffix_dedup.merged([suffix_dedup.front_coded(p) for p in parts]))
    assert [o[0] for o in out] == sorted(r[0] for r in rows)
    assert sorted((o[0], o[2], o[3]) for o in out) == sorted(rows)
    before = b""
    for text, shared, _, _ in out:
        assert shared == suffix_dedup._common(before, text, 0)
        before = text
    assert list(suffix_dedup.merged([])) == []


def test_anchors_depend_on_windows_alone():
    draw = np.random.default_rng(1)
    middle = draw.integers(97, 101, 160, dtype=np.uint8)
    a = np.concatenate([draw.integers(97, 101, 333, dtype=np.uint8), middle])
    b = np.concatenate([middle, draw.integers(97, 101, 77, dtype=np.uint8)])

    def per_window(raw):
        _, at, first, last = suffix_dedup.anchors(raw)
        return {w: p - w for p, f, l in zip(at, first, last) for w in range(f, l + 1)}

    x, y = per_window(a), per_window(b)
    assert all(x[333 + w] == y[w] for w in range(61))
    assert sorted(x) == list(range(len(a) - 99))


def test_registers_merge_and_estimate():
    draw = np.random.default_rng(2)
    pool = np.unique(draw.integers(0, 1 << 63, 3000).astype(np.uint64))
    a, b = pool[:900], pool[100:1000]
    r_a, r_b, r_union = setsketch.registers([a, b, np.union1d(a, b)])
    assert (np.maximum(r_a, r_b) == r_union).all()  # a least point has the greatest grid number
    guess = setsketch.likely_similarity(r_a[None], r_b[None], np.array([900.0]), np.array([900.0]))[0]
    assert abs(guess - 0.8) < 0.12
    assert (setsketch.registers([a])[0] == r_a).all()


def test_folding_undoes_disguise():
    plain = toxicity.fold("loser idiot stupid")
    assert toxicity.fold("L0ser 1D10T $tup!d") == plain
    assert toxicity.fold("lоsеr іdiot stúpid") == plain  # Cyrillic o, e, i
    assert toxicity.fold("call 1001 now!") == ["caii", "1001", "now"]


def test_exception_phrases_cancel_terms():
    lexicon = toxicity.Lexicon({"trash ": 3.0}, ("trash can ",))
    tree = lexicon.automaton()
    assert lexicon.weigh(["trash", "can"], tree)[0] == 0.0
    assert lexicon.weigh(["trash", "trash", "can"], tree)[0] == 3.0


def test_ngrams_do_not_depend_on_chunks(monkeypatch):
    text = "Ein längerer Text mit Wörtern " * 50
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "CHUNK", 97)
    assert (language.ngram_counts(text) == whole).all()


def test_intersections_by_matrix_product(monkeypatch):
    draw = np.random.default_rng(4)
    pool = np.unique(draw.integers(0, 1 << 63, 500).astype(np.uint64))
    sets = [np.sort(draw.choice(pool, int(draw.integers(1, 200)), replace=False)) for _ in range(30)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:9]])
    for columns in (4096, 7):
        monkeypatch.setattr(setsketch, "COLUMNS", columns)
        assert (setsketch._intersections(sets[:9], sets[5:]) == want).all()
    assert setsketch._intersections([], sets).shape == (0, 30)
