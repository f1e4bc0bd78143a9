"""DuckDB SQL for the operators that SQL can express, on the same tables."""

OP1 = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
windows AS (
  SELECT doc_id, p, md5(array_to_string(words[p:p + 49], ' ')) AS content
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM docs WHERE len(words) >= 50)),
firsts AS (SELECT content, min(doc_id) AS first FROM windows GROUP BY content),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i
  FROM windows JOIN firsts USING (content) WHERE doc_id > first),
each AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs)
SELECT d.doc_id, max(len(d.words))::BIGINT AS n_words, count(g.i) AS n_removed,
       sha256(coalesce(string_agg(e.word, ' ' ORDER BY e.i) FILTER (WHERE e.i IS NOT NULL AND g.i IS NULL), '')) AS kept_sha256
FROM docs d LEFT JOIN each e USING (doc_id) LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i
GROUP BY d.doc_id
"""

# the mix of a table {source} with doc_id, text, source: `mixed` has times per row
MIX = r"""
labelled AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
sized AS (
  SELECT d.*, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    -ln((('0x' || substr(md5(concat_ws('|', coalesce(d.doc_id::VARCHAR, 'null'), md5(coalesce(text, '')), '17')), 1, 13))::BIGINT
        + 0.5::DOUBLE) / 4503599627370496)
      / CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS key
  FROM {source} d LEFT JOIN labelled USING (doc_id)),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER f, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0))::DOUBLE AS level,
    row_number() OVER (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST) AS place
  FROM sources
  WINDOW f AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM (SELECT *, least((3 * source_size)::DOUBLE, weight * coalesce(
          (SELECT arg_min(level, place) FROM levels WHERE level * weight <= 3 * source_size), 0)) AS target FROM levels)),
running AS (
  SELECT s.*, source_size, target, epochs, target - epochs * source_size AS rest,
    sum(size) OVER (PARTITION BY s.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS after
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
mixed AS (
  SELECT *, (epochs + CASE WHEN size > 0 AND rest > 0 AND (after <= rest OR
      (after - size < rest AND after - rest < rest - (after - size))) THEN 1 ELSE 0 END)::BIGINT AS times
  FROM running)
"""

OP2 = (
    "WITH "
    + MIX.format(source="documents")
    + " SELECT doc_id, size, source_size, target, size * times AS taken FROM mixed"
)

# sets: (doc_id, shingle) of a table, linked at 80 in 100, and what each reaches
LINKS = r"""
words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM {source}),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS p FROM words WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM {source}
  UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.doc_id),
classes AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
"""

OP3 = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# items of `benchmark` in the documents of {source}
LEAKS = r"""
items AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM benchmark),
item_sets AS (
  SELECT DISTINCT item_id, array_to_string(words[p:p + 4], ' ') AS shingle
  FROM (SELECT item_id, words, unnest(range(1, len(words) - 3)) AS p FROM items)),
item_sizes AS (SELECT item_id, count(*) AS n_item FROM item_sets GROUP BY item_id),
doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM {source}),
doc_sets AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM doc_words)),
leaks AS (
  SELECT doc_id, item_id, n_item, count(*) AS n_common, count(*) / n_item AS containment
  FROM doc_sets JOIN item_sets USING (shingle) JOIN item_sizes USING (item_id)
  GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item)
"""

OP4 = "WITH " + LEAKS.format(source="documents") + " SELECT * FROM leaks"

OP8 = (
    "WITH RECURSIVE "
    + LINKS.format(source="documents")
    + """, copies AS (
  SELECT doc_id, count(*) OVER (PARTITION BY s) AS n_copies
  FROM (SELECT doc_id, list(shingle ORDER BY shingle) AS s FROM sets GROUP BY doc_id))
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_copies, 1) AS n_copies
FROM classes LEFT JOIN sizes USING (doc_id) LEFT JOIN copies USING (doc_id)"""
)

OP10 = r"""
WITH lines AS (
  SELECT rowid_ AS r, doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
  FROM (SELECT row_number() OVER () AS rowid_, doc_id,
               string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE f.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY r, doc_id
"""

# crc32 of a short ASCII text, byte by byte; `crc` holds the table of 256 entries
CRC = """
crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, n)) AS entries)"""
CRC_OF = """xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"""


def _with(path: str, cost: str, edit: str) -> str:
    """A path (nine digits of cost, then its edits) with one edit more."""
    return f"(lpad((left({path}, 9)::INTEGER + {cost})::VARCHAR, 9, '0') || substr({path}, 10) || '{edit}')"


OP11 = f"""
WITH RECURSIVE {CRC},
hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {CRC_OF.format(text="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS hit
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, copy, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit)),
convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
seen AS (
  SELECT c, turn, role, text, row_number() OVER w AS i, row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) AS time,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last,
    left(role, 1) AS initial, lag(left(role, 1)) OVER w AS previous
  FROM damaged d JOIN convs v ON d.conv_id IS NOT DISTINCT FROM v.conv_id
  WINDOW w AS (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(concat_ws('|',
    length(coalesce('=' || d.conv_id, '')), length(role), coalesce('=' || d.conv_id, ''), role, text)), copy)),
faults AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN time > 1 THEN 'duplicate'
    WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    i > 1 AND previous || initial NOT IN ('su', 'ua', 'au') AS illegal FROM seen),
told AS (SELECT *, fault IN ('blank', 'duplicate') AS forced, (fault = 'truncated')::INTEGER AS t FROM faults),
paths AS (  -- one row a step and conversation: the least path into each state
  SELECT c, 0::BIGINT AS i, '000000000' AS e, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM convs
  UNION ALL
  SELECT c, i, {_with("e", "3", "D")},
    least({_with("s", "3", "D")}, CASE WHEN NOT forced AND initial = 's' THEN {_with("e", "t", "K")} END),
    least({_with("u", "3", "D")},
      CASE WHEN NOT forced AND initial = 'u' THEN least({_with("e", "t", "K")}, {_with("s", "t", "K")}, {_with("a", "t", "K")}) END,
      CASE WHEN NOT forced THEN least({_with("e", "2 + t", "R")}, {_with("s", "2 + t", "R")}, {_with("a", "2 + t", "R")}) END),
    least({_with("a", "3", "D")}, CASE WHEN NOT forced AND initial = 'a' THEN {_with("u", "t", "K")} END,
      CASE WHEN NOT forced THEN {_with("u", "2 + t", "R")} END)
  FROM (
    SELECT c, told.i, initial, forced, t, e, s, p.u, least(p.a, {_with("p.u", "2", "I")}) AS a
    FROM (SELECT c, i, e, s, a, least(u, {_with("e", "2", "I")}, {_with("s", "2", "I")}, {_with("a", "2", "I")}) AS u FROM paths) p
    JOIN told USING (c) WHERE told.i = p.i + 1)),
ends AS (
  SELECT c, least(e, a, {_with("u", "2", "I")}, {_with(_with("s", "2", "I"), "2", "I")}) AS path
  FROM paths WHERE (c, i) IN (SELECT (c, max(i)) FROM paths GROUP BY c)),
audits AS (SELECT c, left(path, 9)::BIGINT AS cost, substr(path, 10) AS audit FROM ends),
steps AS (
  SELECT c, p, edit, count(*) FILTER (WHERE edit <> 'I') OVER w AS i, count(*) FILTER (WHERE edit <> 'D') OVER w AS j
  FROM (SELECT c, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS p FROM audits)
  WHERE edit <> ''
  WINDOW w AS (PARTITION BY c ORDER BY p)),
led AS (
  SELECT s.*, t.role, t.text, max((s.j = 1 AND s.edit = 'K' AND t.initial = 's')::INTEGER) OVER (PARTITION BY s.c) AS lead
  FROM steps s LEFT JOIN told t ON t.c = s.c AND t.i = s.i WHERE s.edit <> 'D'),
texts AS (
  SELECT c, string_agg(CASE edit WHEN 'K' THEN role ELSE CASE (j - lead) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS repaired FROM led GROUP BY c),
counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE illegal) AS illegal
  FROM told GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
  sha256(coalesce(repaired, '')) AS repaired_sha256
FROM convs JOIN audits USING (c) LEFT JOIN counted USING (c) LEFT JOIN texts USING (c)
"""

OP13 = f"""
WITH {CRC},
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(concat_ws('|', length(coalesce(role, '')), coalesce(role, ''), coalesce(text, '')))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, {CRC_OF.format(text="conv_id::VARCHAR")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc),
rebuilt AS (
  SELECT c.conv_id, t.i, 0 AS part, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, t.i, 1, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h),
placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth,
    sha256(length(role) || '|' || role || '|' || text) AS turn, strlen(text) AS size FROM rebuilt),
paths AS (
  SELECT conv_id, 0 AS depth, '' AS node, 0 AS size FROM convs
  UNION ALL
  SELECT conv_id, depth, sha256(string_agg(turn, ',') OVER (PARTITION BY conv_id ORDER BY depth)), size FROM placed),
lasts AS (SELECT conv_id, max(depth) AS last FROM paths GROUP BY conv_id),
nodes AS (
  SELECT node, p.depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE p.depth = last) AS ends
  FROM paths p JOIN lasts USING (conv_id) GROUP BY node, p.depth),
parents AS (
  SELECT n.node, n.depth, up.node AS parent, un.conv_id AS parent_conv_id
  FROM nodes n JOIN paths up ON up.conv_id = n.conv_id AND up.depth = n.depth - 1
  JOIN nodes un ON un.node = up.node AND un.depth = up.depth),
kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM parents GROUP BY ALL),
below AS (
  SELECT p.node, p.depth, sum((n.n_convs - 1) * n.size) AS saved_tokens, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth
  LEFT JOIN kids k ON k.node = n.node AND k.depth = n.depth GROUP BY p.node, p.depth)
SELECT n.conv_id, n.depth::BIGINT AS depth, parent_conv_id, n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM nodes n JOIN below USING (node, depth) LEFT JOIN parents USING (node, depth) LEFT JOIN kids USING (node, depth)
"""

ORACLES = {
    "op1_substring_dedup": OP1,
    "op2_source_mix": OP2,
    "op3_topk_search": OP3,
    "op4_decontamination": OP4,
    "op8_ngram_jaccard": OP8,
    "op10_line_dedup": OP10,
    "op11_conversation_repair": OP11,
    "op13_prefix_trie": OP13,
}
