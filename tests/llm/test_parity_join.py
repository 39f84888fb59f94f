"""The parity-sketch join against brute force, and the bounds it rests on."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tallymart.llm import _text, parity_join
from tests.llm.data import documents, prose, texts
from tests.llm.test_dedup_and_index import expected_components


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_join_equals_brute_force(spark, width, percent):
    rows = texts()
    sets, component = expected_components(rows, width, percent)
    got = parity_join.jaccard_join(documents(spark), width, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), component[r.doc_id]), r
    assert {(r.n_shingles > 0, r.component_id) for r in got if r.doc_id is None} == {(False, None), (True, 5)}


def test_shared_passage_with_many_near_misses(spark, monkeypatch):
    """Most words of the sketches are shared by all: blocks of frequent words find the links."""
    monkeypatch.setattr(parity_join, "FEW", 3)
    monkeypatch.setattr(parity_join, "CHUNK", 7)
    rng = random.Random(8)
    passage = prose(rng, 90).split()
    rows = [(i, " ".join(passage + prose(rng, 30).split())) for i in range(40)]
    base = rows[7][1].split()
    for i in range(12):
        w = list(base)
        for _ in range(i % 4 + 1):
            w[rng.randrange(90, len(w))] = f"other{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(w)))
    rows += [(200 + i, rows[i][1]) for i in range(5)]
    sets, component = expected_components(rows, 4, 85)
    got = parity_join.jaccard_join(documents(spark, rows), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: component[i] for i in sets}
    assert len(set(component.values())) < 45


def test_texts_of_one_id_keep_their_own_sets(spark):
    a, b = prose(random.Random(1), 80), prose(random.Random(2), 80)
    rows = [(5, a), (5, b), (9, b), (11, a), (11, a)]
    got = parity_join.jaccard_join(documents(spark, rows), 4, 85).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (5, 5), (9, 5), (11, 5), (11, 5)]


def test_join_of_nothing(spark):
    assert parity_join.jaccard_join(documents(spark, []), 4, 85).collect() == []
    got = parity_join.jaccard_join(documents(spark, [(1, None), (2, ""), (3, "x"), (4, "X")]), 4, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3)]


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_linked_sizes_share_a_band_and_none_lies_in_three(percent):
    least, largest = parity_join.size_bands(percent, 50_000)
    for a in [*range(1, 300), 1234, 9999]:
        held = np.flatnonzero((least <= a) & (a <= largest))
        assert 1 <= len(held) <= 2 and (np.diff(held) == 1).all()
        b = 100 * a // percent
        assert any(least[t] <= b <= largest[t] for t in held), (a, b)


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_word_and_sketches_never_exceed_the_difference(percent):
    rng = np.random.default_rng(5)
    for n in [6, 7, 9, 14, 25, 60, 200, 900]:
        for _ in range(40):
            whole = rng.integers(1, 2**63, 2 * n, dtype=np.uint64)
            lost = rng.integers(0, max(1, n // 12) + 1)
            a, b = np.sort(whole[: n - lost]), np.sort(whole[lost : n + rng.integers(0, 2)])
            shared = len(np.intersect1d(a, b))
            linked = 100 * shared >= percent * (len(a) + len(b) - shared)
            sets, counts = np.concatenate([a, b]), np.array([len(a), len(b)])
            keys, n_keys, _ = parity_join.word_keys(sets, counts, percent)
            if linked and len(np.setxor1d(a, b)):
                assert len(np.intersect1d(keys[: n_keys[0]], keys[n_keys[0] :])), (n, lost)
            bits = parity_join.parity_bits(sets, counts)
            words = min(len(x) // 8 for x in bits)
            x, y = (parity_join._wide([blob], words) for blob in bits)
            different = int(np.bitwise_count(x ^ y).sum())
            assert different <= len(np.setxor1d(a, b))
            if linked:
                assert parity_join.may_link(np.array([len(a)]), np.array([len(b)]), np.array([different]), percent)[0]


def test_null_columns_are_read_as_empty_texts():
    import pyarrow as pa

    steps = list(_text.steps(pa.array([None, None])))
    assert [s.rows for s in steps] == [2] and not len(steps[0].data)
