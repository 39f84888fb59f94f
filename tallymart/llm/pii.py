"""Information-theoretic sanitisation of personal data, with built-in functions only.

Base entities are found by pattern: emails, IP addresses, card numbers that pass Luhn's
check and phone numbers. They are what has to be protected.

Terms near them can give an entity away as well. The corpus tells how strongly: for an
entity e (a kind and a value) and a term t, the information that t holds about e is
``PMI(e; t) = log2(joint * N / (n(e) * n(t)))``, out of e's whole information
``IC(e) = log2(N / n(e))``. What stays unknown is ``IC - PMI = -log2(joint / n(t))`` bits.
Counts are of distinct texts that hold a term, and of distinct surroundings that hold an
entity and a term, so copies prove nothing. A term seen with an entity in at least
``MIN_JOINT`` surroundings that leaves at most ``REMOVE_BITS`` unknown is removed wherever
it occurs; one that leaves at most ``GENERALISE_BITS`` is replaced by its class.

All spans are code points of the original text, end exclusive. A null text is empty. Rows
that repeat are each marked. Term spans never overlap base spans; base spans are all kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.session import stage

KINDS = ("email", "ip", "card", "phone")
# Same matches as the plain patterns, but every run of characters is read once: quantifiers
# are possessive, a match begins where a run begins (or where the match before it ended),
# and too short numbers are no candidates for a card.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for the pattern to have a chance.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

TERM = r"\p{L}{4,}"
WINDOW = 80
HITS, PIECE, REACH = 256, 1024, 4096  # matches added up at once; code points of a piece of text, and of one to look for overlaps in
MIN_JOINT = 2
REMOVE_BITS, GENERALISE_BITS = 0.5, 1.5
BROADCAST_TERMS = 1_000_000

SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _none() -> Column:
    return F.array().cast(SPAN)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(F.lit(False)))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _is_valid(kind: str):
    return lambda span: _valid(kind, span.value)


def _with(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once however often a lambda in it refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _placed(text: Column, pattern: Column, hits: Column, kind: int) -> Column:
    """Spans of ``hits``, all matches of ``pattern`` in ``text``, from the lengths between.

    Lengths are added up in blocks of ``HITS``, then over the blocks, so that no array grows
    hit by hit: the work is linear in the text.
    """
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(hits))
    pairs = F.transform(
        F.arrays_zip(gaps.alias("gap"), hits.alias("hit")),
        lambda x: F.struct(F.length(x.gap).alias("gap"), F.length(x.hit).alias("length"), x.hit.alias("hit")),
    )

    def running(items: Column, zero: Column, add) -> Column:
        """The fold's state after each item."""
        state = F.struct(zero.alias("last"), F.array().cast("array<int>").alias("all"))
        step = lambda acc, x: _with(add(acc.last, x), lambda y: F.struct(y.alias("last"), F.concat(acc.all, F.array(y)).alias("all")))
        return F.aggregate(items, state, step, lambda acc: acc.all)

    def within(block: Column) -> Column:
        return running(block, F.lit(0), lambda at, x: at + x.gap + x.length)

    def placed(block: Column, ends: Column, before: Column) -> Column:
        return F.zip_with(
            block,
            ends,
            lambda x, end: F.struct(
                (before + end - x.length).alias("start"), F.lit(kind).alias("kind"), (before + end).alias("end"), x.hit.alias("value")
            ),
        )

    def whole(pairs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / HITS).cast("int"))
        blocks = F.transform(starts, lambda i: F.slice(pairs, i * HITS + 1, F.lit(HITS)))
        blocks = F.transform(blocks, lambda b: F.struct(b.alias("pairs"), within(b).alias("ends")))
        return _with(blocks, over)

    def over(blocks: Column) -> Column:
        totals = running(blocks, F.lit(0), lambda at, b: at + F.element_at(b.ends, -1))
        before = F.concat(F.array(F.lit(0)), totals)
        parts = F.zip_with(blocks, before, lambda b, at: F.when(b.isNotNull(), placed(b.pairs, b.ends, at)).otherwise(_none()))
        return F.flatten(parts)

    return F.when(F.size(hits) > 0, _with(pairs, whole)).otherwise(_none())


def _entities(docs: DataFrame) -> DataFrame:
    """Add ``body``, ``digest`` and ``base``, the valid spans of each kind."""
    rows = docs.withColumn("body", F.coalesce("text", F.lit("")))
    hits = {}
    for kind in KINDS:
        chance = F.contains("body", F.lit(NEEDS[kind])) if NEEDS[kind] else F.col("body").rlike("[0-9]")
        found = F.regexp_extract_all("body", F.lit(PATTERNS[kind]), F.lit(0))
        hits[f"hits_{kind}"] = F.when(chance, found).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumns(hits)
    spans = [
        F.when(
            F.size(f"hits_{kind}") > 0,
            F.filter(_placed(F.col("body"), F.lit(PATTERNS[kind]), F.col(f"hits_{kind}"), i), _is_valid(kind)),
        ).otherwise(_none())
        for i, kind in enumerate(KINDS)
    ]
    rows = rows.withColumn("base", F.sort_array(F.concat(*spans))).drop(*hits)
    return rows.withColumn("digest", F.md5("body"))


def _surroundings() -> Column:
    """For each base span: its entity, its surroundings' hash and their terms."""

    def near(s: Column, pieces: Column) -> Column:
        # Cut from the pieces around the span, as a substring of the text is found from its start.
        def cut(a: Column, b: Column) -> Column:
            first = F.floor(a / PIECE).cast("int")
            own = F.slice(pieces, first + 1, F.floor(b / PIECE).cast("int") - first + 1)
            return F.substring(F.array_join(own, ""), a - first * PIECE + 1, b - a)

        start = F.greatest(s.start - WINDOW, F.lit(0))
        left, right = cut(start, s.start), cut(s.end, s.end + WINDOW)
        # A word cut by the window's edge is none.
        left = F.when(start > 0, F.regexp_replace(left, r"^\p{L}+", "")).otherwise(left)
        right = F.when(F.length(right) == WINDOW, F.regexp_replace(right, r"\p{L}+$", "")).otherwise(right)
        both = F.lower(F.concat(left, F.lit("\n"), right))
        return F.struct(
            F.xxhash64(s.kind, F.lower(s.value)).alias("entity"),
            F.xxhash64(both).alias("place"),
            F.array_distinct(F.regexp_extract_all(both, F.lit(TERM), F.lit(0))).alias("terms"),
        )

    pieces = F.regexp_extract_all("body", F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    return _with(pieces, lambda p: F.transform("base", lambda s: near(s, p)))


def disclosing_terms(near: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terms that disclose entities, ``(term, bits)``, and the candidates' texts, ``(term, digest)``.

    ``near(entity, place, terms)`` are surroundings of entities; ``docs(body, digest)`` the corpus.
    """
    seen = near.select("entity", "place", F.explode("terms").alias("term")).distinct()
    joint = seen.groupBy("entity", "term").count().filter(F.col("count") >= MIN_JOINT)
    joint, _ = stage(joint.groupBy("term").agg(F.max("count").alias("joint")), "joint")
    n = joint.count()
    terms = F.array_distinct(F.regexp_extract_all(F.lower("body"), F.lit(TERM), F.lit(0)))
    words = docs.select("digest", F.explode(terms).alias("term"))

    def of(wanted: DataFrame, n: int) -> DataFrame:
        wanted = wanted.select("term")
        return words.join(F.broadcast(wanted) if n <= BROADCAST_TERMS else wanted, "term")

    # A term that is common for sure leaves too much unknown: it is dropped by an estimate of
    # its texts, which needs one sketch for each task, before texts are listed by term. The
    # estimate errs by a tenth, so twice the limit is safe.
    about = of(joint, n).groupBy("term").agg(F.approx_count_distinct("digest", 0.1).alias("about"))
    rare = joint.join(about, "term").filter(F.col("about") <= 2 * 2**GENERALISE_BITS * F.col("joint"))
    rare, n = stage(rare, "rare")
    held, _ = stage(of(rare, n).distinct(), "held")
    often = held.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    bits = -F.log2(F.least(F.col("joint") / F.col("n"), F.lit(1.0)))
    found = joint.join(often, "term").select("term", bits.alias("bits")).filter(F.col("bits") <= GENERALISE_BITS)
    return stage(found, "disclosing")[0], held


def spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest, base, spans)`` of every row; ``spans`` adds the term spans to ``base``.

    A span is ``(start, kind, end, value)`` with kinds counted from 0 as in ``KINDS``; a
    term to generalise is kind 4, a term to remove kind 5.
    """
    rows = _entities(docs.select("doc_id", "text"))
    near = F.when(F.size("base") > 0, _surroundings())
    found, _ = stage(rows.select("doc_id", "digest", "base", near.alias("near")), "entities")
    corpus = docs.select(F.coalesce("text", F.lit("")).alias("body")).withColumn("digest", F.md5("body"))
    terms, held = disclosing_terms(found.select(F.explode("near").alias("x")).select("x.*"), corpus)
    marked = held.join(terms, "term").groupBy("digest").agg(F.collect_list(F.struct("term", "bits")).alias("marked"))
    marked, n = stage(marked, "marked")  # at most a text's own distinct terms a row
    marked = F.broadcast(marked) if n <= BROADCAST_TERMS // 10 else marked
    texts = corpus.join(marked, "digest").dropDuplicates(["digest"])
    texts = texts.select("digest", "body", F.explode("marked").alias("m"))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})"), F.col("m.term"), F.lit(r"(?!\p{L})"))
    texts = texts.withColumn("pattern", pattern).withColumn("hits", F.regexp_extract_all("body", F.col("pattern"), F.lit(0)))
    kind = F.when(F.col("m.bits") <= REMOVE_BITS, 5).otherwise(4)
    placed = F.transform(
        _placed(F.col("body"), F.col("pattern"), F.col("hits"), 4),
        lambda s: F.struct(s.start.alias("start"), kind.alias("kind"), s.end.alias("end"), s.value.alias("value")),
    )
    extra = texts.select("digest", placed.alias("more")).groupBy("digest").agg(F.flatten(F.collect_list("more")).alias("more"))
    extra, n = stage(extra, "term-spans")
    extra = F.broadcast(extra) if n <= BROADCAST_TERMS // 10 else extra
    clear = _with(_by_reach(), lambda reach: F.filter("more", lambda m: ~_touched(m, reach)))
    both = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", clear)))
    return found.select("doc_id", "digest", "base").join(extra, "digest", "left").select("doc_id", "digest", "base", both.alias("spans"))


def _by_reach() -> Column:
    """For every ``REACH`` code points up to the last base span, the base spans that touch them."""
    last = F.floor(F.coalesce(F.array_max(F.transform("base", lambda b: b.end)), F.lit(0)) / REACH).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.filter("base", lambda b: (b.start < (i + 1) * REACH) & (b.end > i * REACH))
    )


def _touched(m: Column, reach: Column) -> Column:
    """Whether a base span out of ``reach`` overlaps ``m``."""
    first, last = (F.floor(x / REACH).cast("int") for x in (m.start, m.end - 1))
    near = F.flatten(F.slice(reach, first + 1, last - first + 1))
    return F.exists(near, lambda b: (m.start < b.end) & (b.start < m.end))


def listed(column: str) -> Column:
    """Spans as text, ``kind:start:end`` by commas."""
    names = F.array(*map(F.lit, (*KINDS, "term", "term")))
    return F.array_join(
        F.transform(column, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ","
    )


def counted(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s.kind == KINDS.index(kind))).cast("long")


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that is no column of ``docs``."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def sanitise(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``clean_text``: entities and generalised terms are named
    by their class in brackets, removed terms are gone. Of overlapping spans the first counts. A column ``clean_text`` of
    ``docs`` is replaced, other names do not matter."""
    named = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c != "clean_text"]
    digest, found = (_free(docs, c) for c in ("_digest", "_spans"))
    marked = spans(docs).dropDuplicates(["digest"]).select(F.col("digest").alias(digest), F.col("spans").alias(found))
    body = F.coalesce("text", F.lit(""))
    labels = F.array(*(F.lit(f"[{k.upper()}]") for k in (*KINDS, "term")), F.lit(""))

    def step(acc: Column, s: Column) -> Column:
        done = F.concat(acc.out, F.substring(body, acc.at + 1, s.start - acc.at), F.get(labels, s.kind))
        return F.when(s.start < acc.at, acc).otherwise(F.struct(s.end.alias("at"), done.alias("out")))

    clean = F.aggregate(
        found,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda acc: F.concat(acc.out, F.substring(body, acc.at + 1, F.length(body))),
    )
    rows = docs.withColumn(digest, F.md5(body)).join(marked, digest)
    return rows.select(*named, clean.alias("clean_text"))
