"""Prefix trie and structure repair of conversations against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest

from tallymart.llm import prefix_trie, queries, repair
from tests.llm.data import SPACED

SCHEMA = "conv_id long, turn long, role string, text string, n_convs string, node string, h long, block string, repeated string, audit string"
ROLES = ("system", "user", "assistant", "tool", "", None)


def frame(spark, rows, parts=3):
    made = [(*r, "x", "y", -1, "z", "w", "v") for r in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(parts)


def talks(seed: int = 4) -> list[tuple]:
    """Shared openings, copies, a very long conversation, nulls and repeated rows."""
    rng = random.Random(seed)
    lines = [f"line {i} of some words" + rng.choice([".", "", "!", " \n"]) for i in range(12)] + [None, "", " \t", "?"]
    out = []
    for c in [*range(0, 65), 80, 83, 121, 122, 123, 124, 500, -3, -20, -21]:
        for turn in range(rng.choice([1, 2, 3, 4, 6, 9])):
            out.append((c, turn, rng.choice(ROLES[:3]), rng.choice(lines[:3] if turn < 2 else lines)))
    copied = [(0, "user", "same?"), (1, "assistant", "same."), (2, "user", "again"), (3, "assistant", "so.")]
    out += [(c, *x) for c in range(200, 260) for x in copied]
    out += [(700, t, ROLES[1 + t % 2], f"turn {t % 90}") for t in range(150)]
    out += [(701, t, ROLES[1 + t % 2], f"turn {t % 90}" if t < 100 else "else") for t in range(130)]
    out += [(720, None, "user", "no turn"), (720, None, None, None), (720, 5, "user", "x" * 100_000 + "."), (720, 9, "tool", "y.")]
    out += [(740, 3, "user", "tie."), (740, 3, "user", "tie."), (740, 3, "assistant", "tie."), (740, 4, "user", "tie.")]
    out += [(760, t, None, None) for t in range(3)] + [(780, 0, "user", "a."), (781, 0, "user", "a.")]
    return out


# --- the trie ----------------------------------------------------------------


def expected_trie(rows, tie):
    """Per node (depth, smallest member): the contract's columns; ``tie`` orders rows of a turn."""
    said = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said[c].append(((turn is not None, turn or 0, *tie(role or "", text or "")), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v)] for c, v in said.items()}
    built = {}
    for c, turns in own.items():
        first = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        h = 0 if first == c else zlib.crc32(str(c).encode()) % 4
        built[c] = (own.get(first, [])[:h] if first != c else []) + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        words = len(SPACED.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * words
    out = []
    for p, m in members.items():
        ends = sorted(c for c in m if len(built[c]) == len(p))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), kids[p], leaves[p], saved[p], digest))
    return sorted(out, key=repr)


def hash_ties(spark, rows):
    """The order of rows of one turn, which is by Spark's hash of role and text."""
    pairs = sorted({(r or "", t or "") for _, _, r, t in rows})
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i long, role string, text string")
    got = df.selectExpr("i", "xxhash64(role, text) a", "xxhash64(text, role, 1) b").collect()
    known = {pairs[r.i]: (r.a, r.b) for r in got}
    return lambda role, text: known[role, text]


def trie_of(df):
    return prefix_trie.prefix_trie(*prefix_trie.with_family_heads(prefix_trie.numbered(df)))


def test_trie_equals_brute_force(spark):
    rows = talks() + [(None, 0, "user", "nobody")]
    got = trie_of(frame(spark, rows))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected_trie(rows, hash_ties(spark, rows))


def test_trie_over_many_small_batches(spark):
    """Nodes that lie over the edges of batches and shards are put together."""
    rows = talks(9)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = sorted(map(tuple, trie_of(frame(spark, rows, 7)).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == expected_trie(rows, hash_ties(spark, rows))


def test_trie_of_nothing_and_of_a_turnless_conversation(spark):
    assert trie_of(frame(spark, [])).collect() == []
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    got = trie_of(frame(spark, [(c, 0, "user", "taken away")])).collect()
    digest = hashlib.sha256(str(c).encode()).hexdigest()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, digest)]


# --- the repair --------------------------------------------------------------


def cheapest(rows):
    """Cost, letters and repaired rows of ``(role, text, fault)``, by whole ways to each place."""

    def inserted(best):
        changed = True
        while changed:
            changed = False
            for place, (cost, letters, out) in list(best.items()):
                for then in repair.NEXT[place].values():
                    if then in repair.GIVEN:
                        way = (cost + 2, letters + "I", (*out, (repair.GIVEN[then], "")))
                        if then not in best or way[:2] < best[then][:2]:
                            best[then], changed = way, True
        return best

    best = inserted({0: (0, "", ())})
    for role, text, fault in rows:
        new, extra = {}, int(fault == "truncated")

        def offer(then, way, new=new):
            if then not in new or way[:2] < new[then][:2]:
                new[then] = way

        for place, (cost, letters, out) in best.items():
            offer(place, (cost + 3, letters + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            for letter, then in repair.NEXT[place].items():
                if role[:1] == letter:
                    offer(then, (cost + extra, letters + "K", (*out, (role, text))))
                if then in repair.GIVEN:
                    offer(then, (cost + extra + 2, letters + "R", (*out, (repair.GIVEN[then], text))))
        best = inserted(new)
    return min(best[p] for p in (0, 3) if p in best)


def searched(rows):
    letters, out = [], []

    def emit(letter, times, row):
        letters.append(letter * times)
        out.extend([row] if row else [])

    search = repair.Survivors(emit)
    for r in rows:
        search.row(*r)
    return search.end(), "".join(letters), tuple(out)


def test_search_equals_whole_ways():
    rng = random.Random(11)
    roles, faults = ["system", "user", "assistant", "tool"], [None, "blank", "duplicate", "truncated"]
    for _ in range(2500):
        w = rng.choice([[1, 1, 1, 1], [0, 3, 3, 0], [0, 1, 0, 0], [3, 1, 1, 1], [0, 0, 1, 0], [1, 5, 5, 1]])
        f = rng.choice([[5, 1, 1, 1], [1, 1, 1, 1], [0, 5, 1, 0], [1, 0, 0, 0]])
        n = rng.choice([0, 1, 2, 3, 5, 8, 20, 60])
        rows = [(rng.choices(roles, w)[0], str(i), rng.choices(faults, f)[0]) for i in range(n)]
        assert searched(rows) == cheapest(rows), rows


def test_search_holds_only_what_is_undecided():
    search = repair.Survivors(lambda *_: None)
    for i in range(20_000):
        search.row(("user", "assistant")[i % 2], "text", None if i % 5 else "truncated")
        if i % 7 == 0:
            search.row("tool", "", "blank")
        assert search.undecided() < 12
    for _ in range(20_000):  # a run of deletions is one node
        search.row("user", "", "duplicate")
        assert search.undecided() < 12


def expected_report(rows):
    """The contract's columns per conversation, from rows before the damage."""
    out = {c: [] for c, *_ in rows}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        elif kind == 4:
            role = "user"
        out[c] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    reports = []
    for c, said in out.items():
        said.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, faulty, n, illegal = set(), [], collections.Counter(), 0
        for i, (_, role, text) in enumerate(said):
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, text, fault))
            n[fault] += 1
            illegal += i > 0 and said[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        cost, audit, kept = cheapest(faulty)
        turns = {t for t, _, _ in said if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        reports.append((c, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest, kept))
    return reports


@pytest.mark.parametrize("batch", ["10000", "5"])
def test_repair_equals_brute_force(spark, batch):
    rows = talks(2) + [(None, None, "user", "nobody"), (None, 3, "assistant", "said.")]
    rows += [(c, 0, "user", "only row") for c in range(3000, 3200)]  # some are dropped as a whole
    want = expected_report(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        marked = repair.damaged(frame(spark, rows))
        got = sorted(map(tuple, repair.report(*marked).collect()), key=repr)
        turns = collections.defaultdict(list)
        for r in sorted(repair.repaired(*marked).collect(), key=lambda r: r.place):
            turns[r.conv_id].append((r.role, r.text))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got == sorted((r[:9] for r in want), key=repr)
    assert all(turns[r[0]] == list(r[9]) for r in want)
    empty = hashlib.sha256(b"").hexdigest()
    assert (0, 0, 0, 0, 0, 0, "", empty) in {r[1:] for r in got}


def test_repair_of_nothing(spark):
    assert repair.report(frame(spark, [])).collect() == []
    assert repair.repaired(frame(spark, [])).collect() == []


def test_both_queries_are_registered():
    assert {"op11_conversation_trie", "op12_conversation_repair", "op13_jaccard_join"} <= set(queries.llm_queries())
