"""Conversation structure repair: the cheapest edits, by Viterbi with survivor coalescence.

A conversation is well formed if the first letters of its roles read ``(s?(ua)+)?``. Edits run
over its rows in order:

``K``  keep the row                         costs 0
``R``  give it the role user or assistant   costs 2
``D``  delete it                            costs 3, required if it is blank or a duplicate
``I``  insert an empty user or assistant    costs 2, anywhere

A truncated row that stays costs 1 more. The cheapest edits win, and among equally cheap ones
those whose letters come first in ASCII.

A row's fault is the first that holds: ``blank`` (nothing but white space), ``duplicate`` (role
and text stood earlier in the conversation), ``truncated`` (its last character that isn't white
space is none of ``.!?``).

Rows stream through a task sorted by conversation and turn. For each of the four places in the
pattern (before all, after s, u, a) one survivor is kept, the best way there so far. Survivors
are leaves of one tree of back pointers with reference counts. Once all survivors share an
ancestor, the edits up to it are emitted and forgotten; runs of deletions are one node. So a
task holds what is undecided, and never a conversation. Ways of equal cost are compared by
their whole undecided suffixes. Survivors that can't win any more are given up.

Duplicates are told by 128-bit hashes of role and text in a shuffle of their own, so that no
task holds what a conversation has said.

Null roles and texts are one space. Null turns come first; rows of one turn are ordered by role
and text, equal ones lie side by side. A null conv_id is a conversation. Empty tables give no
rows. Columns beside conv_id, turn, role and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Costs of edits, the pattern as next places by letter, and inserted rows.
RETITLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
GIVEN = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED_TEXT = "blank", "duplicate", "truncated"

REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, place long, edit string, role string, text string"
OUT_ROWS = 2000


class _Edit:
    """A node of the tree: an edit after those of ``up``. ``age`` falls towards the root."""

    __slots__ = ("age", "letter", "refs", "row", "times", "up")

    def __init__(self, up: _Edit | None, letter: str, row: tuple[str, str] | None):
        self.up, self.letter, self.row = up, letter, row
        self.age, self.times, self.refs = up.age + 1 if up else 0, 1, 0
        if up:
            up.refs += 1


class Survivors:
    """The search over one conversation. ``emit(letter, times, row)`` gets each decided edit."""

    def __init__(self, emit: Callable[[str, int, tuple[str, str] | None], None]):
        self.emit = emit
        self.root = _Edit(None, "", None)
        self.root.refs = 1
        self.best: dict[int, tuple[int, _Edit]] = {START: (0, self.root)}
        # The survivors of the row before, and which of two comes first where that is decided.
        self.old = {id(self.root): self.root}
        self.order: dict[tuple[int, int], bool] = {}
        self._inserted()
        self._remember()

    def _first(self, a: _Edit, b: _Edit, last_a: str = "", last_b: str = "") -> bool | None:
        """Whether the edits up to a, and ``last_a``, come before those of b; None if one is the
        beginning of the other. An order once decided holds for all that follows, so only what
        came since the row before is read, or else all that is undecided."""
        one, two, old = [last_a], [last_b], self.old
        while a is not b:
            if id(a) in old and id(b) in old:
                first = self.order.get((id(a), id(b)))
                if first is not None:
                    return first
                old = {}
            if id(b) in old or id(a) not in old and a.age >= b.age:
                one.append(a.letter * a.times)
                a = a.up
            else:
                two.append(b.letter * b.times)
                b = b.up
        x, y = "".join(reversed(one)), "".join(reversed(two))
        return None if x.startswith(y) or y.startswith(x) else x < y

    def _remember(self) -> None:
        nodes = [node for _, node in self.best.values()]
        order = {(id(a), id(b)): self._first(a, b) for a in nodes for b in nodes if a is not b}
        self.order = {k: v for k, v in order.items() if v is not None}
        self.old = {id(node): node for node in nodes}

    def _release(self, node: _Edit) -> None:
        node.refs -= 1
        while node.refs == 0 and node.up is not None:
            node = node.up
            node.refs -= 1

    def _take(self, ways: dict[int, tuple[int, _Edit, str, tuple[str, str] | None]]) -> None:
        """The ways become the survivors; each holds its node."""
        old = list(self.best.values())
        self.best = {}
        for place, (cost, up, letter, row) in ways.items():
            node = _Edit(up, letter, row)
            node.refs += 1
            self.best[place] = (cost, node)
        for _, node in old:
            self._release(node)

    def _inserted(self) -> None:
        for place, then in ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if place not in self.best:
                continue
            cost, up = self.best[place]
            cost += INSERT
            known = self.best.get(then)
            if known:
                tied = known[1]
                if known[0] < cost or known[0] == cost and not self._first(up, tied, "I"):
                    continue
            node = _Edit(up, "I", (GIVEN[then], ""))
            node.refs += 1
            self.best[then] = (cost, node)
            if known:
                self._release(known[1])

    def row(self, role: str, text: str, fault: str | None) -> None:
        letter, extra = role[:1], TRUNCATED if fault == TRUNCATED_TEXT else 0
        ways: dict[int, tuple[int, _Edit, str, tuple[str, str] | None]] = {}

        def offer(then: int, cost: int, up: _Edit, edit: str, row: tuple[str, str] | None) -> None:
            known = ways.get(then)
            if not known or cost < known[0] or cost == known[0] and self._first(up, known[1], edit, known[2]):
                ways[then] = (cost, up, edit, row)

        for place, (cost, up) in self.best.items():
            offer(place, cost + DELETE, up, "D", None)
            if fault in (BLANK, DUPLICATE):
                continue
            for first, then in NEXT[place].items():
                if letter == first:
                    offer(then, cost + extra, up, "K", (role, text))
                if then in GIVEN:
                    offer(then, cost + extra + RETITLE, up, "R", (GIVEN[then], text))
        self._take(ways)
        self._inserted()
        self._give_up()
        self._remember()
        self._join_deletions()
        self._decide()

    def _give_up(self) -> None:
        """What follows a survivor can follow the one after an assistant as well, at most a
        deleted system row dearer; so one that is dearer by more can't win."""
        if ASSISTANT not in self.best:
            return
        bound = self.best[ASSISTANT][0]
        for place, most in ((START, DELETE), (SYSTEM, 0)):
            if place in self.best and self.best[place][0] > bound + most:
                self._release(self.best.pop(place)[1])

    def _join_deletions(self) -> None:
        for _, leaf in self.best.values():
            for node in (leaf, leaf.up):
                while node is not None and node.letter == "D" and node.up.letter == "D" and node.up.refs == 1:
                    gone = node.up
                    node.times, node.age, node.up = node.times + gone.times, gone.age, gone.up

    def _decide(self) -> None:
        held = {id(node) for _, node in self.best.values()}
        if self.root.refs != 1 or id(self.root) in held:
            return
        node, path = next(iter(self.best.values()))[1], []
        while node is not self.root:
            path.append(node)
            node = node.up
        while path and self.root.refs == 1 and id(self.root) not in held:
            self.root = path.pop()
            self.emit(self.root.letter, self.root.times, self.root.row)
            self.root.letter, self.root.up, self.root.row = "", None, None

    def undecided(self) -> int:
        """Nodes that are held now."""
        nodes = {}
        for _, node in self.best.values():
            while node is not None:
                nodes[id(node)] = node
                node = node.up
        return len(nodes)

    def end(self) -> int:
        """Emit the rest of the cheapest whole way; returns its cost."""
        ends = [self.best[p] for p in (START, ASSISTANT) if p in self.best]
        cost, node = ends[0]
        for other, last in ends[1:]:
            if other < cost or other == cost and self._first(last, node):
                cost, node = other, last
        path = []
        while node is not self.root:
            path.append(node)
            node = node.up
        for node in reversed(path):
            self.emit(node.letter, node.times, node.row)
        return cost


class _Conversation:
    def __init__(self, conv_id: int | None, turns: list | None):
        self.conv_id, self.turns = conv_id, turns
        self.counts = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED_TEXT), 0)
        self.illegal = self.distinct = self.place = 0
        self.least = self.last = self.before = None
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.search = Survivors(self._emit)

    def _emit(self, letter: str, times: int, row: tuple[str, str] | None) -> None:
        self.audit.append(letter * times)
        if row is None:
            return
        self.digest.update(("\n" if self.place else "").encode() + f"{row[0]}:{row[1]}".encode())
        if self.turns is not None:
            self.turns.append((self.conv_id, self.place, letter, *row))
        self.place += 1

    def row(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        if turn is not None and turn != self.last:
            self.distinct += 1
            self.least = turn if self.least is None else self.least
            self.last = turn
        said = text.strip(SPACE)
        fault = BLANK if not said else DUPLICATE if repeated else TRUNCATED_TEXT if said[-1] not in ".!?" else None
        if fault:
            self.counts[fault] += 1
        letter = role[:1]
        if self.before is not None and self.before + letter not in LEGAL:
            self.illegal += 1
        self.before = letter
        self.search.row(role, text, fault)

    def report(self) -> tuple:
        cost = self.search.end()
        gaps = self.last - self.least + 1 - self.distinct if self.distinct else 0
        return (self.conv_id, gaps, *self.counts.values(), self.illegal, cost, "".join(self.audit), self.digest.hexdigest())


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in ddl.split(", "))])


def _scan(reports: bool):
    """Over rows sorted by conversation and turn: a report each, or the repaired turns."""
    schema = _arrow(REPORT if reports else TURNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        turns = None if reports else out
        for batch in batches:
            for conv_id, turn, role, text, repeated, there in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        last = now.report()
                        out += [last] if reports else []
                    now = _Conversation(conv_id, turns)
                if there:
                    now.row(turn, role, text, repeated)
                if len(out) >= OUT_ROWS:
                    yield _batch(out, schema)
                    out.clear()
        if now is not None:
            last = now.report()
            out += [last] if reports else []
        if out:
            yield _batch(out, schema)

    return run


def _sorted(rows: DataFrame, there: Column) -> DataFrame:
    """Rows by conversation and turn with a mark of repetition. Rows that aren't ``there`` only
    tell that their conversation exists."""
    said = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), there.alias("there"),
    )
    said = said.withColumns({"role": F.when(F.col("there"), F.col("role")), "text": F.when(F.col("there"), F.col("text"))})
    same = ["conv_id", "there", "h1", "h2"]
    said = said.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", "role", F.lit(1))})
    nth = F.row_number().over(Window.partitionBy(*same).orderBy(F.asc_nulls_first("turn")))
    said = said.withColumn("repeated", nth > 1).select("conv_id", "turn", "role", "text", "repeated", "there")
    return said.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "repeated")


def report(rows: DataFrame, there: Column | None = None) -> DataFrame:
    """Per conversation: missing turn numbers, faults, illegal neighbours, cost and letters of
    the cheapest edits, and the hash of the repaired rows ``role:text`` joined by line breaks."""
    return _sorted(rows, F.lit(True) if there is None else there).mapInArrow(_scan(True), REPORT)


def repaired(rows: DataFrame, there: Column | None = None) -> DataFrame:
    """The rows that every conversation has after its repair, with their place and edit."""
    return _sorted(rows, F.lit(True) if there is None else there).mapInArrow(_scan(False), TURNS)


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with faults drawn from a hash of conversation and turn, and which of them are there.

    A twentieth each is dropped, emptied, robbed of ``.!?``, repeated, and said by user."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(told[0], F.lit(":"), told[1])) % 20
    text = F.coalesce("text", F.lit(" "))
    changed = rows.select(
        "conv_id", "turn", kind.alias("kind"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
    )
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return changed.withColumn("copy", copies), F.col("kind") != 0
