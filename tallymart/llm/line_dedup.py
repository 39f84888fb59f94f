"""Removal of repeated line runs by a suffix array over line ids, built by prefix doubling.

Every document is a sequence of line ids (blank lines are left out). A line that occurs once
in the corpus ends every repeat, so the suffixes that start at repeated lines are all that
has to be sorted:

* level 0 ranks suffixes by their first line; level k+1 ranks pairs of level k, of a suffix
  and of the one 2**k lines on. Pairs that occur once are dropped, the others are sorted
  and numbered in order, so ranks order the suffixes by their first 2**k lines;
* suffixes of equal rank share a prefix: they are an interval of the array whose longest
  common prefix has at least that length. The interval of any length L between powers is
  told by two overlapping ranks.

A run of lines is deleted if it has at least ``min_words`` words, and an equal run begins
earlier in the corpus (by doc_id, then text) without overlapping it. A maximal repeated run
is covered by its shortest long-enough windows, one from each of its lines forwards and one
backwards; so intervals are looked up at these lengths only, and no group of suffixes is
ever compared pair by pair.

Line ends need not agree, and a passage may begin or end inside a line. So the words that
are left are decided one by one: a word goes if a window of ``min_words`` words around it
repeats an earlier window without overlapping it, wherever the lines end in either. Windows
inside deleted runs are left out: such a run has an equal one earlier, so the first of equal
windows is never in it. Every other window picks the least hash of the short word runs in it;
windows whose pick occurs once in the corpus can't repeat and are never listed.

Of equal texts under several doc_ids only the first is compared; the later ones go as a whole
if they have ``min_words`` words. Keys that hold more than a ``HOT_SHARE``-th of all rows (so
fewer than that many) are joined by broadcast, all others by shuffle.

Null texts are empty; they and texts without repeats come back unchanged. Rows equal in
doc_id and text are one document and treated alike; a null doc_id sorts first. Lines
and words are compared without regard to ASCII case. A very long text is a step of its own,
in memory that grows with its words. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import _text
from tallymart.session import stage

MIN_WORDS = 50
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

_LINES = np.ones(256, dtype=bool)
_LINES[10] = False


def _word_sums(texts: _text.Texts) -> np.ndarray:
    """How many words begin before each byte."""
    inside = _text.SPACE_SEPARATED[texts.data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = texts.offsets[:-1][texts.offsets[:-1] < len(inside)]
    first[bounds] = inside[bounds]
    return np.r_[0, np.cumsum(first)]


def _line_counts(texts: _text.Texts) -> np.ndarray:
    """How many lines of each text hold a word."""
    sums = _word_sums(texts)
    ends = np.unique(np.r_[np.flatnonzero(~_LINES[texts.data]), texts.offsets[1:]])
    some = np.diff(np.r_[0, sums[ends]]) > 0
    return np.bincount(np.searchsorted(texts.offsets[1:], ends[some] - 1, side="right"), minlength=texts.rows)


def _lines(texts: _text.Texts):
    """Lines that hold a word: their document, byte range, key and number of words."""
    lines = _text.words(texts, _LINES)
    sums = _word_sums(texts)
    counts = sums[lines.end] - sums[lines.start]
    some = counts > 0
    return lines.doc[some], lines.start[some], lines.end[some], lines.key[some], counts[some]


def _windows(doc: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the shortest window of enough words from each line on, and up to each line; 0 if none."""
    n = len(doc)
    ends = np.cumsum(counts)
    starts = ends - counts
    line = np.arange(n)
    forward = np.searchsorted(ends, starts + least, side="left")
    there = np.minimum(forward, n - 1)
    forward = np.where((forward < n) & (doc[there] == doc), forward - line + 1, 0) if n else line
    backward = np.searchsorted(starts, ends - least, side="right") - 1
    there = np.maximum(backward, 0)
    backward = np.where((backward >= 0) & (doc[there] == doc), line - backward + 1, 0) if n else line
    return forward, backward


def _line_rows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _text.steps(batch.column(2)):
                doc, _, _, key, counts = _lines(texts)
                forward, backward = _windows(doc, counts, least)
                ends = np.cumsum(np.bincount(doc, minlength=texts.rows))
                bounds = pa.array(np.r_[0, ends].astype(np.int32))
                own = lambda x, t, bounds=bounds: pa.ListArray.from_arrays(bounds, pa.array(x, t))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(texts.first, texts.rows) for c in batch.columns[:2]),
                        own(key.view(np.int64), pa.int64()),
                        own(forward, pa.int32()),
                        own(backward, pa.int32()),
                    ],
                    ["id", "digest", "keys", "forward", "backward"],
                )

    return run


def _spans(key: np.ndarray, n: int) -> np.ndarray:
    """A key of the ``n`` words from each word on, whichever document they are in."""
    m = len(key) - n + 1
    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(key), _STEP)])
    back = np.cumprod(np.r_[np.uint64(1), np.full(len(key), _BACK)])
    sums = np.r_[np.uint64(0), np.cumsum(key * powers[:-1])]
    return _text.mix((sums[n:] - sums[:-n]) * back[:m])


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Place of the least of ``x[i : i + n]`` for each ``i``, the first of equal ones."""

    def merged(step: int) -> np.ndarray:
        left, right = at[: len(at) - step], at[step:]
        return np.where(x[right] < x[left], right, left)

    at, span = np.arange(len(x)), 1
    while 2 * span <= n:
        at, span = merged(span), 2 * span
    return merged(n - span) if n > span else at


def _gone_words(texts: _text.Texts, w: _text.Words, runs: pa.Array) -> np.ndarray | None:
    """Which words lie in the rows' deleted runs of lines; None if there are no runs."""
    found = runs.to_pylist()
    if not any(found):
        return None
    doc, _, end, _, _ = _lines(texts)
    n_lines = np.bincount(doc, minlength=texts.rows)
    return _gone_lines(found, n_lines)[np.searchsorted(end, w.start, side="right")]


def _gone_lines(runs: list, n_lines: np.ndarray) -> np.ndarray:
    base = np.cumsum(n_lines) - n_lines
    gone = np.zeros(int(n_lines.sum()), bool)
    for row, windows in enumerate(runs):
        for x in windows or ():
            gone[base[row] + x["line"] : base[row] + x["line"] + x["length"]] = True
    return gone


def _word_windows(texts: _text.Texts, least: int, runs: pa.Array):
    """Windows of ``least`` words that are not all in ``runs``: document, first word in it, key,
    and place and key of the pick."""
    w = _text.words(texts, _text.SPACE_SEPARATED)
    if len(w.key) < least:
        none = np.empty(0, np.int64)
        return none, none, none.view(np.uint64), none, none.view(np.uint64)
    at = np.arange(len(w.key) - least + 1)
    one = w.doc[at] == w.doc[at + least - 1]
    gone = _gone_words(texts, w, runs)
    if gone is not None:
        sums = np.r_[0, np.cumsum(gone)]
        one &= sums[least:] - sums[:-least] < least
    short = (least + 1) // 2
    small = _spans(w.key, short)
    pick = _least(small, least - short + 1)[one]
    at = at[one]
    counts = np.bincount(w.doc, minlength=texts.rows)
    base = (np.cumsum(counts) - counts)[w.doc[at]]
    return w.doc[at], at - base, _spans(w.key, least)[at], pick - base, small[pick]


def _pick_rows(least: int):
    """The picks of every document, each place once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _text.steps(batch.column(2)):
                doc, _, _, place, key = _word_windows(texts, least, batch.column(3).slice(texts.first, texts.rows))
                own = np.ones(len(doc), bool)
                own[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
                ends = np.cumsum(np.bincount(doc[own], minlength=texts.rows))
                picks = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(key[own].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(texts.first, texts.rows) for c in batch.columns[:2]), picks], ["id", "digest", "picks"]
                )

    return run


def _window_rows(least: int):
    """Windows whose pick is repeated, and whether an equal one of the document ends before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _text.steps(batch.column(2)):
                doc, start, key, _, pick = _word_windows(texts, least, batch.column(3).slice(texts.first, texts.rows))
                picks = batch.column(4).slice(texts.first, texts.rows)
                ends = np.cumsum(np.bincount(doc, minlength=texts.rows))
                for row, (a, b) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)):
                    asked = picks[row].values
                    if asked is None or a == b:
                        continue
                    at = a + np.flatnonzero(np.isin(pick[a:b].view(np.int64), asked.to_numpy()))
                    if not len(at):
                        continue
                    _, first, same = np.unique(key[at], return_index=True, return_inverse=True)
                    own = start[at] >= start[at][first][same] + least
                    ids = batch.column(0)[texts.first + row].as_py()
                    digest = batch.column(1)[texts.first + row].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), ids), pa.int64()),
                            pa.array(np.full(len(at), digest), pa.int64()),
                            pa.array(key[at].view(np.int64)),
                            pa.array(start[at], pa.int32()),
                            pa.array(own),
                        ],
                        ["id", "digest", "window", "start", "own"],
                    )

    return run


def _word_runs(least: int):
    """The windows' starts of a document as runs of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = []
            for starts in batch.column(2).to_pylist():
                x = np.unique(np.array(starts, np.int64))
                cut = np.flatnonzero(np.diff(x) > least) + 1
                first, last = x[np.r_[0, cut]], x[np.r_[cut, len(x)] - 1] + least
                runs.append([{"first": a, "end": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(runs, kind)], ["id", "digest", "spans"])

    return run


def _joined_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of lines of a document as disjoint runs."""
    for batch in batches:
        runs = []
        for windows in batch.column(2).to_pylist():
            x = np.array(sorted((w["line"], w["line"] + w["length"]) for w in windows), np.int64)
            ends = np.maximum.accumulate(x[:, 1])
            cut = np.flatnonzero(x[1:, 0] > ends[:-1]) + 1
            first, end = x[np.r_[0, cut], 0], ends[np.r_[cut, len(x)] - 1]
            runs.append([{"line": a, "length": b - a} for a, b in zip(first.tolist(), end.tolist(), strict=True)])
        kind = pa.list_(pa.struct([("line", pa.int32()), ("length", pa.int32())]))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(runs, kind)], ["id", "digest", "runs"])


def _shortened(texts_column: pa.Array, copy: np.ndarray, runs: list, spans: list, least: int):
    """Texts without what goes, and their numbers of lines and words that went."""
    out, lines_gone, words_gone = texts_column.to_pylist(), [], []
    for texts in _text.steps(texts_column):
        w = _text.words(texts, _text.SPACE_SEPARATED)
        doc, start, end, _, counts = _lines(texts)
        line = np.searchsorted(end, w.start, side="right")
        n_lines = np.bincount(doc, minlength=texts.rows)
        base = np.cumsum(n_lines) - n_lines
        n_words = np.bincount(w.doc, minlength=texts.rows)
        word_base = np.cumsum(n_words) - n_words
        own = slice(texts.first, texts.first + texts.rows)
        whole = copy[own] & (n_words >= least)
        word_gone = (_gone_lines(runs[own], n_lines) | whole[doc])[line]
        for row, found in enumerate(spans[own]):
            for x in found or ():
                word_gone[word_base[row] + x["first"] : word_base[row] + x["end"]] = True
        lost = np.bincount(line[word_gone], minlength=len(doc))
        gone = lost == counts
        for row in np.unique(w.doc[word_gone]).tolist():
            raw, parts, at = out[texts.first + row].encode(), [], 0
            offset = texts.offsets[row]
            for i in (np.flatnonzero(lost[base[row] : base[row] + n_lines[row]]) + base[row]).tolist():
                if gone[i]:
                    parts.append(raw[at : int(start[i] - offset)])
                    at = int(end[i] - offset) + 1  # with its line break
                    continue
                a, b = np.searchsorted(line, [i, i + 1])
                edge = np.diff(np.r_[False, word_gone[a:b], False].astype(np.int8))
                for x, y in zip((np.flatnonzero(edge == 1) + a).tolist(), (np.flatnonzero(edge == -1) + a).tolist(), strict=True):
                    parts.append(raw[at : int(w.start[x] - offset)])  # up to the next word that stays
                    at = int((w.start[y] if y < b else end[i]) - offset)
            out[texts.first + row] = b"".join([*parts, raw[at:]]).decode()
        lines_gone.append(np.bincount(doc[gone], minlength=texts.rows))
        words_gone.append(np.bincount(doc, lost, minlength=texts.rows).astype(np.int64))
    return out, np.concatenate(lines_gone), np.concatenate(words_gone)


def _rebuild(least: int):
    """Texts without the deleted runs of lines and of words; later copies without all lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts_column = batch.column(1).fill_null("")
            n_lines = np.concatenate([_line_counts(texts) for texts in _text.steps(texts_column)])
            n_deleted, words_deleted = np.zeros((2, batch.num_rows), np.int64)
            out = texts_column
            copy, runs, spans = batch.columns[2:]
            copy = copy.to_numpy(zero_copy_only=False)
            at = np.flatnonzero(copy | runs.is_valid().to_numpy(zero_copy_only=False) | spans.is_valid().to_numpy(zero_copy_only=False))
            if len(at):
                part = pa.array(at)
                texts, n_deleted[at], words_deleted[at] = _shortened(
                    texts_column.take(part), copy[at], runs.take(part).to_pylist(), spans.take(part).to_pylist(), least
                )
                mask = np.zeros(batch.num_rows, bool)
                mask[at] = True
                out = pc.replace_with_mask(texts_column, pa.array(mask), pa.array(texts, texts_column.type))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_deleted), pa.array(words_deleted), out],
                ["doc_id", "n_lines", "n_deleted", "words_deleted", "text"],
            )

    return run


def _with_few(rows: DataFrame, table: DataFrame, size: int, on: list[str], how: str) -> DataFrame:
    """A join with ``table`` of about ``size`` bytes, which is broadcast if it is small."""
    return rows.join(F.broadcast(table) if size <= BROADCAST_BYTES else table, on, how)


def _size(table: DataFrame, *lists: str) -> int:
    """Bytes of rows of a few numbers and of the lists of structs or numbers."""
    entries = sum((F.coalesce(F.size(x), F.lit(0)) for x in lists), F.lit(0))
    return table.agg(F.sum(entries * 32 + 100)).first()[0] or 0


def _on_repeated(rows: DataFrame, key: str, *values) -> DataFrame:
    """``rows`` whose key occurs more than once, with the aggregates ``values`` of the key."""
    often = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *values).filter("n > 1")
    often, _ = stage(often, "often")
    limit = (often.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE
    hot, n_hot = stage(often.filter(F.col("n") > limit), "hot")
    found = rows
    if n_hot:
        found = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    found = found.join(often.filter(F.col("n") <= limit).drop("n"), key)
    return found.union(rows.join(F.broadcast(hot.drop("n")), key)) if n_hot else found


def suffix_ranks(suffixes: DataFrame, levels: int) -> list[DataFrame]:
    """Ranks ``(id, digest, line, rank)`` by the first 1, 2, 4, ... lines, for ``levels`` levels.

    ``suffixes(id, digest, line, key)`` are the repeated lines. Ranks of a level increase with
    the sorted prefixes; suffixes whose prefix occurs once have none.
    """
    ranks, span = [suffixes.select("id", "digest", "line", F.col("key").alias("rank"))], 1
    for _ in range(1, levels):
        own = ranks[-1]
        next_ = own.select("id", "digest", (F.col("line") - span).alias("line"), F.col("rank").alias("rank2"))
        pairs, n = stage(own.join(next_, ["id", "digest", "line"]), "pairs")
        if not n:
            break
        names = pairs.groupBy("rank", "rank2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        names, _ = stage(names.orderBy("rank", "rank2").withColumn("name", F.monotonically_increasing_id()), "names")
        ranked = pairs.join(names, ["rank", "rank2"]).select("id", "digest", "line", F.col("name").alias("rank"))
        ranks.append(stage(ranked, "ranks")[0])
        span *= 2
    return ranks


def later_copies(docs: DataFrame, min_words: int) -> DataFrame:
    """``(id, digest, runs)``: runs of lines ``(line, length)`` that repeat earlier ones."""
    lines, _ = stage(
        docs.select("id", "digest", "text").mapInArrow(
            _line_rows(min_words), "id long, digest long, keys array<long>, forward array<int>, backward array<int>"
        ),
        "lines",
    )
    flat = lines.select(
        "id", "digest", F.posexplode(F.arrays_zip("keys", "forward", "backward")).alias("line", "x")
    ).select("id", "digest", "line", F.col("x.keys").alias("key"), F.col("x.forward").alias("forward"), F.col("x.backward").alias("backward"))
    suffixes, _ = stage(_on_repeated(flat, "key").dropDuplicates(["id", "digest", "line"]), "suffixes")
    windows = suffixes.select("id", "digest", "line", F.col("forward").alias("length")).union(
        suffixes.select("id", "digest", F.col("line") - F.col("backward") + 1, "backward")
    )
    windows, _ = stage(windows.filter("length > 0 AND line >= 0").distinct(), "windows")
    longest = windows.agg(F.max("length")).first()[0] or 1
    ranks = suffix_ranks(suffixes, longest.bit_length())
    classes = None
    for level, rank in enumerate(ranks):
        own = windows.filter(F.col("length").between(1 << level, (2 << level) - 1))
        last = rank.select("id", "digest", F.col("line").alias("at"), F.col("rank").alias("rank2"))
        found = (
            own.withColumn("at", F.col("line") + F.col("length") - (1 << level))
            .join(rank, ["id", "digest", "line"])
            .join(last, ["id", "digest", "at"])
            .select("id", "digest", "line", "length", "rank", "rank2")
        )
        classes = found if classes is None else classes.union(found)
    classes, _ = stage(classes, "intervals")
    interval = ["length", "rank", "rank2"]
    first = classes.groupBy(*interval).agg(F.min(F.struct("id", "digest", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
    met = classes.join(first.filter("n > 1").drop("n"), interval)
    apart = (F.col("id") != F.col("first.id")) | (F.col("digest") != F.col("first.digest"))
    met = met.filter(apart | (F.col("line") >= F.col("first.line") + F.col("length")))
    met = met.groupBy("id", "digest").agg(F.collect_set(F.struct("line", "length")).alias("runs"))
    return met.mapInArrow(_joined_runs, "id long, digest long, runs array<struct<line: int, length: int>>")


def later_words(docs: DataFrame, min_words: int) -> DataFrame:
    """``(id, digest, spans)``: runs of words ``(first, end)`` whose windows repeat earlier ones.

    ``docs(id, digest, text, runs)``: windows inside the runs of lines are left out.
    """
    own = docs.select("id", "digest", "text", "runs")
    picks, _ = stage(own.mapInArrow(_pick_rows(min_words), "id long, digest long, picks array<long>"), "picks")
    flat = picks.select("id", "digest", F.explode("picks").alias("pick"))
    asked, _ = stage(_on_repeated(flat, "pick").groupBy("id", "digest").agg(F.collect_set("pick").alias("picks")), "asked")
    windows = _with_few(own, asked, _size(asked, "picks") // 4, ["id", "digest"], "inner").select("id", "digest", "text", "runs", "picks")
    windows, _ = stage(windows.mapInArrow(_window_rows(min_words), "id long, digest long, window long, start int, own boolean"), "word_windows")
    later = _on_repeated(windows.filter("NOT own"), "window", F.min(F.struct("id", "digest")).alias("first"))
    later = later.filter(F.struct("id", "digest") > F.col("first"))
    met = windows.filter("own").select("id", "digest", "start").union(later.select("id", "digest", "start"))
    met = met.groupBy("id", "digest").agg(F.collect_list("start").alias("starts"))
    return met.mapInArrow(_word_runs(min_words), "id long, digest long, spans array<struct<first: long, end: long>>")


def drop_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, n_lines, n_deleted, words_deleted, text)`` of every row of ``docs(doc_id, text)``."""
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.md5(F.coalesce("text", F.lit(""))).alias("md5"),
        "text",
    )
    copied = rows.groupBy("md5").agg(F.min("id").alias("original"), F.max("id").alias("last"))
    copied, n = stage(copied.filter("original < last").drop("last"), "copied")
    digest = F.conv(F.substring("md5", 1, 15), 16, 10).cast("long")
    rows = _with_few(rows, copied, 100 * n, ["md5"], "left").select(
        "doc_id", "id", digest.alias("digest"), "text", F.coalesce(F.col("id") > F.col("original"), F.lit(False)).alias("copy")
    )
    originals = rows.filter("NOT copy")
    runs, _ = stage(later_copies(originals, min_words), "runs")
    spans = later_words(_with_few(originals, runs, _size(runs, "runs"), ["id", "digest"], "left"), min_words)
    found, _ = stage(runs.join(spans, ["id", "digest"], "full"), "found")
    out = _with_few(rows, found, _size(found, "runs", "spans"), ["id", "digest"], "left").select("doc_id", "text", "copy", "runs", "spans")
    return out.mapInArrow(_rebuild(min_words), "doc_id long, n_lines long, n_deleted long, words_deleted long, text string")
