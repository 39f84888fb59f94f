"""SQL counterparts of the training-data queries, for DuckDB, where SQL can express them.

Not here: disclosing terms (op1), suffix ranks with their deletions (op3), the classifiers (op6,
op10), hash-drawn samples (op7), the smallest feasible capacity (op9) and the pipeline.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _near(width: int, columns: str) -> str:
    """Links of word shingles at 85 %, and the smallest doc_id reached over them."""
    return rf"""
WITH RECURSIVE words AS (
SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingled AS (
SELECT DISTINCT doc_id, array_to_string(w[i : i + {width - 1}], ' ') AS shingle
FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width - 1}, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), common AS (
SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
), edges AS (
SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
SELECT doc_id AS a, doc_id AS b FROM documents
UNION
SELECT r.a, e.b FROM reached r JOIN edges e ON r.b = e.a
), least_of AS (
SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, {columns}
FROM least_of LEFT JOIN sizes USING (doc_id)
"""


_TOP = """
WITH vectors AS (
SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
FROM embeddings
WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 20
"""

_HITS = rf"""
WITH item_words AS (
SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
SELECT DISTINCT item_id, least(len(w), 13) AS n, w[i : i + 12] AS phrase
FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), doc_windows AS (
SELECT doc_id, n, i, w[i : i + n - 1] AS phrase
FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
      FROM doc_words CROSS JOIN (SELECT DISTINCT n FROM item_windows))
), found AS (
SELECT DISTINCT doc_id, item_id, i, d.n FROM doc_windows d JOIN item_windows t ON d.phrase = t.phrase
), hit AS (
SELECT doc_id, count(DISTINCT p) AS n_hit
FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), named AS (
SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_CHAT = r"""
WITH said AS (
SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 24) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""



def _crc32(text: str) -> str:
    """CRC-32 bit by bit: each byte is XORed in, then eight shifts."""
    bits = f"list_transform(string_split({text}, ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])"
    step = "lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END"
    return f"xor(CAST(4294967295 AS BIGINT), list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten({bits})), {step}))"


_TRIE = rf"""
WITH said AS (
SELECT conv_id, md5(concat(length(coalesce(role, '')), ':', role, text)) AS id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS family,
       CASE WHEN conv_id % 20 = 0 THEN 0 ELSE {_crc32("CAST(conv_id AS VARCHAR)")} % 4 END AS h
FROM said GROUP BY conv_id
), convs AS (
SELECT c.*, least(c.h, coalesce(f.n, 0)) AS taken FROM sizes c LEFT JOIN sizes f ON c.family = f.conv_id
), rebuilt AS (
SELECT c.conv_id, s.pos + 1 AS depth, id, words FROM convs c JOIN said s ON s.conv_id = c.family AND s.pos < c.h
UNION ALL
SELECT c.conv_id, s.pos - h + taken + 1, id, words FROM convs c JOIN said s ON s.conv_id = c.conv_id AND s.pos >= c.h
), paths AS (
SELECT conv_id, depth, words, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
UNION ALL
SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words FROM paths GROUP BY ALL
), tops AS (
SELECT a.depth, a.path, a.conv_id, p.conv_id AS parent_conv_id, a.n, a.words,
       (SELECT count(*) FROM nodes c WHERE c.depth = a.depth + 1 AND starts_with(c.path, a.path)) AS n_children
FROM nodes a LEFT JOIN nodes p ON p.depth = a.depth - 1 AND p.path = left(a.path, length(a.path) - 32)
), below AS (
SELECT a.depth, a.path, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n - 1) * b.words) AS saved
FROM tops a JOIN tops b ON b.depth >= a.depth AND starts_with(b.path, a.path) GROUP BY ALL
), ends AS (
SELECT depth, path, string_agg(conv_id, ',' ORDER BY conv_id) AS ids
FROM (SELECT * FROM paths QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n AS n_convs, n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM tops LEFT JOIN below USING (depth, path) LEFT JOIN ends USING (depth, path)
"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _way(source: str, cost: str, letter: str, row: str | None = None) -> str:
    row = f"list_append({source}.o, {row})" if row else f"{source}.o"
    return f"struct_pack(c := {source}.c + {cost}, a := {source}.a || '{letter}', o := {row})"


def _ways(target: int) -> str:
    """The best way to a place over the next row; what can't be costs a million."""
    sources, letter, role = {0: ((), "", ""), 1: ((0,), "s", ""), 2: ((0, 1, 3), "u", "user"), 3: ((2,), "a", "assistant")}[target]
    found = [_way(f"s{target}", "3", "D")]
    for x in sources:
        found.append(_way(f"s{x}", f"CASE WHEN must OR first <> '{letter}' THEN 1000000 ELSE tail END", "K", "role || ':' || text"))
        if role:
            found.append(_way(f"s{x}", "CASE WHEN must THEN 1000000 ELSE 2 + tail END", "R", f"'{role}:' || text"))
    return f"list_min([{', '.join(found)}])"


_REPAIR = rf"""
WITH RECURSIVE told AS (
SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations
), damaged AS (
SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
       CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
       unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
FROM told WHERE kind <> 0
), placed AS (
SELECT *, left(role, 1) AS first, right(rtrim(text, {_SPACES}), 1) AS said,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
       row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
FROM damaged
), faulty AS (
SELECT *, CASE WHEN said = '' THEN 'b' WHEN again THEN 'd' WHEN said NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
       lag(first) OVER (PARTITION BY conv_id ORDER BY i) AS before
FROM placed
), counts AS (
SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
       count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
       count(*) FILTER (WHERE before || first NOT IN ('su', 'ua', 'au')) AS illegal
FROM faulty GROUP BY conv_id
), steps AS (
SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS s0, {{'c': 1000000, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS s1,
       {{'c': 2, 'a': 'I', 'o': ['user:']}} AS s2, {{'c': 4, 'a': 'II', 'o': ['user:', 'assistant:']}} AS s3
FROM counts
UNION ALL
SELECT conv_id, i, t0, t1, u2, list_min([t3, {_way("u2", "2", "I", "'assistant:'")}])
FROM (SELECT *, list_min([t2, {_way("t0", "2", "I", "'user:'")}, {_way("t1", "2", "I", "'user:'")}, {_way("t3", "2", "I", "'user:'")}]) AS u2
  FROM (SELECT conv_id, i, {", ".join(f"{_ways(x)} AS t{x}" for x in range(4))}
    FROM (SELECT s.conv_id, f.i, f.role, f.text, f.first, f.fault IN ('b', 'd') AS must, CASE WHEN f.fault = 't' THEN 1 ELSE 0 END AS tail, s0, s1, s2, s3
          FROM steps s JOIN faulty f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1)))
), best AS (
SELECT s.conv_id, list_min([s0, s3]) AS way FROM steps s JOIN counts c ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.n
)
SELECT t.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(way.c, 0) AS BIGINT) AS cost,
       coalesce(way.a, '') AS audit, sha256(coalesce(array_to_string(way.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) t
LEFT JOIN counts c ON t.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best b ON t.conv_id IS NOT DISTINCT FROM b.conv_id
"""


def llm_oracle() -> dict[str, str]:
    return {
        "op2_near_duplicates": _near(3, "component_id, doc_id = component_id AS kept"),
        "op4_top_inner_products": _TOP,
        "op5_decontamination": _HITS,
        "op8_chat": _CHAT,
        "op11_conversation_trie": _TRIE,
        "op12_conversation_repair": _REPAIR,
        "op13_jaccard_join": _near(4, "component_id"),
    }
