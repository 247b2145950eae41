"""DuckDB SQL that gives the same rows as the queries it can express."""

WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_PLAIN = r"string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+', ' ', 'g')), ' ')"
_SHINGLES = """
  SELECT DISTINCT {key}, CASE WHEN len(w) <= 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 4], ' ') END AS shingle
  FROM {words}, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0 AND w[1] <> ''
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents), b AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
ds AS ({_SHINGLES.format(key="doc_id", words="d")}), bs AS ({_SHINGLES.format(key="item_id", words="b")}),
n AS (SELECT item_id, count(*) AS item_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, item_shingles, count(*) AS shared, count(*) / item_shingles AS containment
FROM ds JOIN bs USING (shingle) JOIN n USING (item_id)
GROUP BY doc_id, item_id, item_shingles HAVING count(*) * 100 >= item_shingles * 80
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
                               " 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS ({_SHINGLES.format(key="doc_id", words="d")}),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
counted AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM counted JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * common >= 85 * (a.n + b.n - common)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""

SUBSTRING = f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
starts AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS passage
  FROM d, unnest(range(1, greatest(len(w) - 18, 1))) AS t(i)),
later AS (SELECT doc_id, i FROM starts QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM later, unnest(range(i, i + 20)) AS t(p)),
words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
marked AS (
  SELECT doc_id, p, word, gone.p IS NOT NULL AS removed FROM words LEFT JOIN gone USING (doc_id, p)),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT removed), '') AS kept_text
  FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_SAFE = "replace(coalesce({0}, ''), '<|', '< |')"
_HEAD = f"'<|' || {_SAFE.format('role')} || '|>' || chr(10)"
_BODY = f"{_SAFE.format('text')} || '<|end|>' || chr(10)"

PREFERENCES = f"""
WITH own AS (
  SELECT DISTINCT conv_id AS pair_id, turn, role, text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
answers AS (
  SELECT pair_id, turn AS last, text AS other FROM own WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY turn DESC, text DESC NULLS LAST) = 1),
sides AS (
  SELECT 'c' AS side, own.* FROM own SEMI JOIN answers USING (pair_id)
  UNION ALL
  SELECT 'r', own.* FROM own JOIN answers USING (pair_id) WHERE turn < last
  UNION ALL
  SELECT 'r', a.pair_id, a.last, 'assistant', b.other FROM answers a JOIN answers b ON b.pair_id = xor(a.pair_id, 1)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY side, pair_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM sides),
matched AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.pos, r.pos) AS pos,
         c.pos IS NULL OR r.pos IS NULL OR c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text AS differs
  FROM (SELECT * FROM placed WHERE side = 'c') c
  FULL JOIN (SELECT * FROM placed WHERE side = 'r') r ON c.pair_id = r.pair_id AND c.pos = r.pos),
common AS (
  SELECT pair_id, CAST(coalesce(min(pos) FILTER (WHERE differs) - 1, max(pos)) AS INTEGER) AS prompt_turns
  FROM matched GROUP BY pair_id),
rest AS (
  SELECT side, pair_id, pos, role, {_HEAD} AS head, {_BODY} AS body, pos <= prompt_turns AS in_prompt
  FROM placed JOIN common USING (pair_id)),
spans AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (
    PARTITION BY side, pair_id, in_prompt ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    + length(head) AS first
  FROM rest),
made AS (
  SELECT pair_id,
    coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (WHERE side = 'c' AND in_prompt), '') AS prompt,
    coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (WHERE side = 'c' AND NOT in_prompt), '') AS chosen,
    coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (WHERE side = 'r' AND NOT in_prompt), '') AS rejected,
    coalesce(string_agg(CAST(first AS BIGINT) || ':' || CAST(first + length(body) - 1 AS BIGINT), ',' ORDER BY pos)
      FILTER (WHERE side = 'c' AND NOT in_prompt AND role = 'assistant'), '') AS chosen_mask,
    coalesce(string_agg(CAST(first AS BIGINT) || ':' || CAST(first + length(body) - 1 AS BIGINT), ',' ORDER BY pos)
      FILTER (WHERE side = 'r' AND NOT in_prompt AND role = 'assistant'), '') AS rejected_mask
  FROM spans GROUP BY pair_id)
SELECT pair_id, CASE WHEN chosen = '' AND rejected = '' THEN 'same' WHEN chosen = '' OR rejected = '' THEN 'one_sided'
                ELSE 'ok' END AS status, prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask
FROM made JOIN common USING (pair_id)
"""


def _crc32(code_points: str) -> str:
    """Unsigned CRC-32 of a list of bytes, bit by bit: 3988292384 is its fixed polynomial."""
    step = "list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, byte))"
    return f"xor(list_reduce({code_points}, lambda crc, byte: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


_DIGITS = "list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(substr(s, i, 1)) AS BIGINT))"

PREFIX_TRIE = f"""
WITH RECURSIVE own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS nth
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS first, {_crc32(_DIGITS)} % 4 AS h
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM own)),
rebuilt AS (
  SELECT convs.conv_id, own.role, own.text, 0 AS part, nth FROM convs JOIN own ON own.conv_id = first WHERE nth <= h
  UNION ALL
  SELECT convs.conv_id, own.role, own.text, 1 AS part, nth FROM convs JOIN own USING (conv_id) WHERE nth > h),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, nth) AS depth,
         sha256(CAST(length(role) AS VARCHAR) || ':' || role || text) AS turn,
         len({WORDS.format("text")}) AS words
  FROM rebuilt),
paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS depth, '' AS node, CAST(NULL AS VARCHAR) AS parent, 0 AS words FROM convs
  UNION ALL
  SELECT turns.conv_id, turns.depth, sha256(node || turn), node, turns.words
  FROM paths JOIN turns ON turns.conv_id = paths.conv_id AND turns.depth = paths.depth + 1),
ended AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id),
nodes AS (
  SELECT node, any_value(parent) AS parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(words) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = n), '')) AS ends_sha256
  FROM paths JOIN ended USING (conv_id) GROUP BY node, depth),
families AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT paths.node, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
  FROM nodes LEFT JOIN families USING (node)
  JOIN paths ON paths.conv_id = nodes.conv_id AND paths.depth <= nodes.depth GROUP BY paths.node)
SELECT nodes.conv_id, nodes.depth, above.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN below USING (node) LEFT JOIN families USING (node) LEFT JOIN nodes above ON above.node = nodes.parent
"""

_BYTES = "list_transform(range(1, octet_length(b) + 1), lambda i: CAST('0x' || substr(hex(b), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT))"
_SMALL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SPELLING = f"""
WITH RECURSIVE found AS (
  SELECT doc_id, {_SMALL.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))")} AS run FROM documents),
runs AS (
  SELECT doc_id, run, count(*) AS n, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS b
  FROM found WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (SELECT run, n, {_crc32(_BYTES)} AS h FROM runs),
spelt AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
            ELSE run END AS word FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
  FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
shorter AS (SELECT DISTINCT p.word AS a, w.word AS b FROM places p JOIN words w ON w.word = p.head || p.tail),
near AS (
  SELECT a.word AS word, b.word AS other
  FROM places a JOIN places b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION
  SELECT a, b FROM shorter
  UNION
  SELECT b, a FROM shorter),
best AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN words o ON o.word = near.other
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) = 1),
formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 5 * words.n THEN other END AS form, CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
ways AS (
  SELECT word, word AS place FROM formed
  UNION ALL
  SELECT ways.word, formed.form FROM ways JOIN formed ON formed.word = ways.place WHERE formed.form IS NOT NULL),
ends AS (SELECT ways.word, place AS root FROM ways JOIN formed ON formed.word = place WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
