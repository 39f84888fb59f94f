"""Near-duplicates, repeated lines and decontamination against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tallymart.llm import _text, decontaminate, line_dedup, near_dedup
from tallymart.llm._graph import components, union_find
from tests.llm.data import SPACED, WORDS, documents, lower, prose, shingles, texts


def expected_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets[i] = shingles(t, width)
    ids = [i for i in sets if sets[i]]
    links = []
    for n, a in enumerate(ids):
        for b in ids[:n]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    return sets, {i: i for i in sets} | union_find(links)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, width, percent):
    rows = texts()
    sets, component = expected_components(rows, width, percent)
    got = near_dedup.near_duplicates(documents(spark), width, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), component[r.doc_id]), r
            assert r.kept == (r.doc_id == component[r.doc_id])
    lost = {(r.n_shingles > 0, r.component_id, r.kept) for r in got if r.doc_id is None}
    assert lost == {(False, None, False), (True, 5, False)}
    groups = collections.Counter(component.values())
    assert groups[0] >= 91 and groups[1] >= 60


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(documents(spark, [])).collect() == []
    one = near_dedup.near_duplicates(documents(spark, [(None, "a b c d e f g"), (None, "a b c d e f g")])).collect()
    assert [(r.component_id, r.kept) for r in one] == [(None, False)] * 2


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    values = near_dedup.super_minhash(np.concatenate([a[:3000], a[1000:]]), np.array([3000, 3000]))
    assert abs((values[0] == values[1]).mean() - 0.5) < 0.12
    few = near_dedup.super_minhash(a[:3], np.array([2, 1, 0]))
    assert (few[:2] < 2**63).all() and (few[2] == 2**64 - 1).all()


def test_short_sets_at_the_threshold_are_missed_as_rarely_as_stated():
    pairs = 25_000
    for percent, union, shared in ((80, 5, 4), (85, 7, 6), (80, 10, 8)):
        bands, rows = near_dedup.banding(percent)
        x = np.random.default_rng(union).integers(0, 2**63, (pairs, union), dtype=np.uint64)
        own = (union - shared) // 2
        sides = (x[:, : shared + own], np.hstack([x[:, :shared], x[:, shared + own :]]))
        a, b = (
            near_dedup.super_minhash(np.ascontiguousarray(s).reshape(-1), np.full(pairs, s.shape[1]))[:, : bands * rows] for s in sides
        )
        found = (a == b).reshape(pairs, bands, rows).all(axis=2).any(axis=1)
        assert (~found).sum() <= 2, (percent, union)


def test_each_element_draws_a_permutation(monkeypatch):
    monkeypatch.setattr(near_dedup, "PART", 3)
    x = np.random.default_rng(4).integers(0, 2**63, 10, dtype=np.uint64)
    alone = near_dedup.super_minhash(x, np.ones(10, int))
    ranks = np.sort(alone >> np.uint64(48), axis=1)
    assert (ranks == np.arange(near_dedup.SLOTS)).all()
    together = near_dedup.super_minhash(x, np.array([4, 0, 6]))
    assert (together == [alone[:4].min(axis=0), np.full(near_dedup.SLOTS, 2**64 - 1, np.uint64), alone[4:].min(axis=0)]).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (2000, 2001), (2001, 2000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got == {x: r for x, r in union_find(edges).items() if x not in ()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected_runs(rows, least):
    seq = {}
    for i, t in rows:
        key = (-(1 << 63) if i is None else i, hashlib.md5((t or "").encode()).hexdigest())
        seq[key] = [(lower(x), len(SPACED.findall(x))) for x in (t or "").split("\n") if SPACED.search(x)]
    windows = collections.defaultdict(set)
    for key, lines in seq.items():
        for a in range(len(lines)):
            for step, stop in ((1, len(lines)), (-1, -1)):
                n = 0
                for b in range(a, stop, step):
                    n += lines[b][1]
                    if n >= least:
                        lo, hi = min(a, b), max(a, b) + 1
                        windows[tuple(x for x, _ in lines[lo:hi])].add((*key, lo, hi))
                        break
    gone = collections.defaultdict(set)
    for places in windows.values():
        first = min(places)
        for i, d, a, b in places:
            if (i, d) != first[:2] or a >= first[3]:
                gone[i, d] |= set(range(a, b))
    return seq, gone


def expected_words(rows, least):
    """Places of the words that go, by document (doc_id and digest): those in windows that repeat an earlier one."""
    split = {}
    for i, t in rows:
        split[-(1 << 63) if i is None else i, hashlib.md5((t or "").encode()).hexdigest()] = SPACED.findall(lower(t or ""))
    places = collections.defaultdict(list)
    for key in sorted(split):
        for a in range(len(split[key]) - least + 1):
            places[tuple(split[key][a : a + least])].append((key, a))
    gone = collections.defaultdict(set)
    for found in places.values():
        for key, a in found[1:]:
            if key != found[0][0] or a >= found[0][1] + least:
                gone[key] |= set(range(a, a + least))
    return split, gone


def run_rows():
    passage = "\n".join(f"line {i} of a passage that stands in several documents and is long" for i in range(6))
    return texts() + [
        (800, f"start\n{passage}\nend"), (801, f"{passage}\n\n  \nother"), (802, "\n".join(passage.split("\n")[:4]) + "\nmore"),
        (803, "short line\nshort line"), (804, "\n".join(["same line again and again here"] * 40)),
        (805, "a\n" + "\n".join(["same line again and again here"] * 3)),
    ]


def test_repeated_line_runs_equal_brute_force(spark):
    rows = run_rows()
    _, gone = expected_runs(rows, 50)
    number = lambda digest: int(digest[:15], 16)
    table = [(-(1 << 63) if i is None else i, number(hashlib.md5((t or "").encode()).hexdigest()), t) for i, t in rows]
    found = line_dedup.later_copies(spark.createDataFrame(table, "id long, digest long, text string"), 50).collect()
    got = {(r.id, r.digest): {x for run in r.runs for x in range(run.line, run.line + run.length)} for r in found}
    assert got == {(i, number(digest)): lines for (i, digest), lines in gone.items() if lines}
    assert all(a.line + a.length < b.line for r in found for a, b in zip(r.runs, r.runs[1:], strict=False))
    assert gone[(801, hashlib.md5(rows[-5][1].encode()).hexdigest())] == set(range(6))


def test_repeated_words_equal_brute_force(spark):
    rows = run_rows()
    split, gone = expected_words(rows, 50)
    got = line_dedup.drop_repeated_runs(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = collections.defaultdict(list)
    for i, t in rows:
        by_id[i].append(t)
    for r in got:
        if len(by_id[r.doc_id]) > 1 and r.doc_id is None:
            continue
        t = by_id[r.doc_id][0] or ""
        key = (r.doc_id, hashlib.md5(t.encode()).hexdigest())
        kept = [x for n, x in enumerate(split[key]) if n not in gone[key]]
        assert SPACED.findall(lower(r.text)) == kept and r.words_deleted == len(gone[key]), r.doc_id
        before, after = ([x for x in v.split("\n") if SPACED.search(x)] for v in (t, r.text))
        assert (r.n_lines, r.n_deleted) == (len(before), len(before) - len(after))
        if not gone[key]:
            assert r.text == t
    assert line_dedup.drop_repeated_runs(documents(spark, [])).count() == 0


def test_later_copies_of_a_text_go_if_they_are_long(spark):
    rng = random.Random(41)
    long, short = prose(rng, 50), prose(rng, 49)
    rows = [(9, long), (3, long), (3, long), (5, short), (4, short), (None, "x"), (8, None), (7, "")]
    got = collections.Counter((r.doc_id, r.text) for r in line_dedup.drop_repeated_runs(documents(spark, rows)).collect())
    assert got == collections.Counter([(9, ""), (3, long), (3, long), (5, short), (4, short), (None, "x"), (8, ""), (7, "")])


@pytest.mark.parametrize("seed", range(3))
def test_passages_cut_into_lines_anew_equal_brute_force(spark, seed):
    """Few words and shared passages, so that runs begin, end and overlap everywhere."""
    rng = random.Random(seed)
    passages = [[f"w{rng.randrange(30)}" for _ in range(rng.randrange(8, 60))] for _ in range(4)]
    rows = []
    for i in range(60):
        words = [x for _ in range(rng.randrange(1, 5)) for x in (rng.choice(passages) if rng.random() < 0.7 else [f"v{rng.randrange(9)}" for _ in range(20)])]
        rows.append((i, "".join(x + rng.choice([" "] * 8 + ["\n", "\n\n"]) for x in words)))
    split, gone = expected_words(rows, 20)
    assert any(gone.values())
    for r in line_dedup.drop_repeated_runs(documents(spark, rows), 20).collect():
        key = (r.doc_id, hashlib.md5(rows[r.doc_id][1].encode()).hexdigest())
        assert r.text.split() == [x for n, x in enumerate(split[key]) if n not in gone[key]], r.doc_id


def test_passages_inside_long_lines_equal_brute_force(spark):
    own = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    just, less, long = own("p", 50), own("q", 49), own("r", 130)
    bodies = [
        f"{own('a', 60)} {just} {own('b', 7)}", f"{own('c', 9)} {just} {own('d', 80)}", f"{own('e', 50)} {less}", f"{own('f', 70)} {less} {own('g', 3)}",
        f"{long} {own('h', 20)}", f"{own('i', 33)} {' '.join(long.split()[20:120])} x {own('j', 30)}", f"{own('k', 55)} {just} {just} {own('l', 5)}",
        own("m", 50), own("n", 65), own("n", 65), " ".join(["same"] * 180),
    ]
    rows = list(enumerate(bodies))
    split, gone = expected_words(rows, 50)
    left = {i: [x for n, x in enumerate(t.split(" ")) if n not in gone[key]] for (i, t), key in zip(rows, split, strict=True)}
    got = {r.doc_id: r for r in line_dedup.drop_repeated_runs(documents(spark, rows)).collect()}
    for i, text in rows:
        r = got[i]
        assert r.text.split() == left[i], i
        assert (r.n_lines, r.words_deleted) == (1, len(text.split()) - len(left[i])), i
        assert r.n_deleted == (not left[i]), i
        assert r.text == text if len(left[i]) == len(text.split()) else True
    assert [got[i].words_deleted for i in (1, 3, 5, 9)] == [50, 0, 100, 65]


def test_a_passage_goes_wherever_it_has_its_line_ends(spark):
    own = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    first, second = own("p", 30), own("Q", 40)
    rows = [
        (1, f"{own('a', 10)} {first}\n{second} {own('b', 8)}\nend"), (2, f"é\n\n{own('c', 9)}  {first} {second.lower()}\t{own('d', 9)}\n \nlast é"),
        (3, f"start\n{own('e', 60)} {first} {second}\nlast"), (4, f"{own('f', 10)} {first}\n{second}"),
    ]
    got = {r.doc_id: r for r in line_dedup.drop_repeated_runs(documents(spark, rows)).collect()}
    assert got[1].text == rows[0][1]
    assert got[2].text == f"é\n\n{own('c', 9)}  {own('d', 9)}\n \nlast é" and (got[2].n_deleted, got[2].words_deleted) == (0, 70)
    assert got[3].text == f"start\n{own('e', 60)} \nlast" and got[3].words_deleted == 70
    assert got[4].text == own("f", 10) + " \n" and (got[4].n_deleted, got[4].words_deleted) == (1, 70)


ITEMS = [(1, " ".join(f"q{i}" for i in range(20))), (2, "Alpha beta, gamma"), (3, None), (4, "..."), (5, " ".join(f"q{i}" for i in range(5, 18))), (2, "delta"), (None, "omega omega")]


def expected_hits(text, items, width):
    w = WORDS.findall(lower(text))
    hit, found = [False] * len(w), set()
    for item, t in items:
        v = WORDS.findall(lower(t))
        n = min(width, len(v))
        for a in range(len(v) - n + 1) if n else []:
            for s in range(len(w) - n + 1):
                if w[s : s + n] == v[a : a + n]:
                    hit[s : s + n] = [True] * n
                    if item is not None:
                        found.add(str(item))
    return len(w), sum(hit), sorted(found)


def test_decontamination_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 4)  # several blocks
    monkeypatch.setattr(decontaminate, "CANDIDATES", 3)
    q = [f"Q{i}" for i in range(20)]
    rows = texts()[:20] + [
        (900, " ".join(q)), (901, "x " + "-".join(q[3:18]) + " y"), (902, " ".join(q[:12])), (903, "alpha BETA gamma delta! omega omega omega"),
        (904, None), (905, ""), (906, " ".join(q[:13]) + " z " * 200), (907, "alpha"), (908, "beta gamma"), (None, "delta"), (900, " ".join(q)),
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    index = decontaminate.positional_index(documents(spark, rows))
    got = decontaminate.contamination(index, items).withColumn("bad", decontaminate.is_contaminated()).collect()
    want = collections.Counter()
    for i, t in rows:
        n, hit, found = expected_hits(t, ITEMS, 13)
        want[i, n, hit, tuple(found), hit > 0 and 20 * hit >= n] += 1
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.bad) for r in got) == want
    for r in got:
        assert sum(s.end - s.first for s in r.spans) == r.n_hit
    none = decontaminate.contamination(index, items.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.n_hit for r in none)
    assert decontaminate.contamination(decontaminate.positional_index(documents(spark, [])), items).count() == 0


def test_proximity_matches(spark):
    items = spark.createDataFrame([(1, "red green blue black")], "item_id long, text string")
    rows = [(1, "red green blue black"), (2, "red green x blue black"), (3, "green red black blue"), (4, "red a b c green blue black")]
    index = decontaminate.positional_index(documents(spark, rows))
    got = {r.doc_id: (r.n_hit, r.n_near > 0) for r in decontaminate.contamination(index, items, slop=1).collect()}
    assert got == {1: (4, True), 2: (0, True), 3: (0, False), 4: (0, False)}


def test_words_are_those_of_the_patterns():
    import pyarrow as pa

    column = pa.array(["Ab cé-d\x00e", None, "", "  ", "x" * 5000 + " y", "ß　z"])
    for pattern, classes in ((SPACED, _text.SPACE_SEPARATED), (WORDS, _text.ALPHANUMERIC)):
        for step in _text.steps(column, 10):
            w = _text.words(step, classes)
            for k, text in enumerate(column.to_pylist()[step.first : step.first + step.rows]):
                own = [step.data[a:b].tobytes().decode() for a, b, d in zip(w.start, w.end, w.doc, strict=True) if d == k]
                assert own == pattern.findall(lower(text))
    tokens = [t for s in _text.steps(pa.array(["a!! b|c"])) for t in [_text.words(s, _text.TOKENS)]]
    assert len(tokens[0].key) == 5
    assert re.fullmatch(WORDS, "abc1")
