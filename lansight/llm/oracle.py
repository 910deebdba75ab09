"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from lansight.llm.chat_format import AFTER_ROLE, END, ESCAPES, ROLE_ESCAPES, START, ChatRules
from lansight.llm.line_dedup import LineRules
from lansight.llm.near_dedup import SketchRules
from lansight.llm.periodic_runs import RunRules
from lansight.llm.sharding import DIGITS, ShardRules

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_RULES = LineRules()

LINE_DEDUP = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT r, doc_id, string_split(text, chr(10)) AS l FROM docs),
lines AS (SELECT r, doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM parts),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_WHITE})")} AS k FROM lines),
repeated AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= {_RULES.min_chars}
             GROUP BY k HAVING count(DISTINCT doc_id) >= {_RULES.min_docs}),
marked AS (SELECT keyed.*, (keeper IS NOT NULL AND doc_id < keeper) AS gone FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

_CHAT = ChatRules()


def _escaped_length(column: str, pairs) -> str:
    for plain, coded in pairs:
        column = f"replace({column}, '{plain}', '{coded}')"
    return f"length({column})"


CHAT_FORMAT = f"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS seq FROM every),
sized AS (SELECT *, seq = 1 AND role = '{_CHAT.system_role}' AS is_system,
                 len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) + {_CHAT.turn_overhead} AS tokens,
                 {len(START) + len(AFTER_ROLE) + len(END)} + {_escaped_length('role', ROLE_ESCAPES)}
                   + {_escaped_length('text', ESCAPES)} AS chars FROM numbered),
owned AS (SELECT *, CASE WHEN is_system THEN 0 ELSE tokens END AS own,
                 max(CASE WHEN is_system THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS sys FROM sized),
roomy AS (SELECT *, greatest(1, {_CHAT.budget - _CHAT.history_budget} - sys
                                - max(own) OVER (PARTITION BY conv_id)) AS room,
                 sum(own) OVER (PARTITION BY conv_id ORDER BY seq) - own AS before FROM owned),
spans AS (SELECT *, before // room AS span FROM roomy),
carried AS (SELECT *, NOT is_system AND row_number() OVER back <= {_CHAT.history_turns}
                      AND sum(tokens) OVER back <= {_CHAT.history_budget}
                      AND span < max(span) OVER (PARTITION BY conv_id) AS carry,
                   count(DISTINCT span) OVER (PARTITION BY conv_id) AS n_windows
            FROM spans WINDOW back AS (PARTITION BY conv_id, span ORDER BY seq DESC))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = '{_CHAT.target_role}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY seq) FILTER (role = '{_CHAT.target_role}'), '')) AS loss_sha256,
       sum(chars + CASE WHEN carry THEN chars ELSE 0 END
           + CASE WHEN is_system THEN chars * (n_windows - 1) ELSE 0 END)::BIGINT AS formatted_chars,
       max(n_windows)::BIGINT AS n_windows
FROM carried GROUP BY conv_id
"""

_WORDS = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"

# The checksum of the standard archives, byte by byte over a table of the 256 remainders.
_CRC_TABLE = """bits(b, k, v) AS (SELECT b, 0, b::BIGINT FROM range(256) t(b) UNION ALL
  SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8)"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes; needs the table ``crc`` in FROM."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)),
  lambda a, x: xor(a >> 8, crc.t[((xor(a, x) & 255) + 1)::INT])), 4294967295)"""


PREFIX_TRIE = f"""
WITH RECURSIVE {_CRC_TABLE},
turns AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)),
ids AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc),
again AS (SELECT conv_id, i, role, text FROM turns JOIN ids USING (conv_id) WHERE i > h
  UNION ALL SELECT ids.conv_id, i, role, text FROM ids JOIN turns ON turns.conv_id = ids.conv_id - ids.conv_id % 20 AND i <= h),
prefixes AS (SELECT conv_id, row_number() OVER o AS d, len({_WORDS.format("text")}) AS words,
  string_agg(md5(role) || md5(text), '') OVER o AS k FROM again WINDOW o AS (PARTITION BY conv_id ORDER BY i)),
members AS (SELECT conv_id, 0 AS d, 0 AS words, '' AS k FROM ids UNION ALL SELECT conv_id, d, words, k FROM prefixes),
nodes AS (SELECT k, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n, min(words) AS words,
  CASE WHEN min(d) > 0 THEN left(k, length(k) - 64) END AS parent FROM members GROUP BY k),
families AS (SELECT parent AS k, count(*) AS n_children FROM nodes GROUP BY parent),
up AS (SELECT left(nodes.k, 64 * unnest(range(depth + 1))) AS k, (n_children IS NULL)::INT AS leaf, (n - 1) * words AS saved
  FROM nodes LEFT JOIN families USING (k)),
subtrees AS (SELECT k, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY k),
ends AS (SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM members
  JOIN (SELECT conv_id, max(d) AS d FROM members GROUP BY conv_id) USING (conv_id, d) GROUP BY k)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, above.conv_id AS parent_conv_id, nodes.n::BIGINT AS n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN subtrees USING (k) LEFT JOIN families USING (k) LEFT JOIN ends USING (k)
LEFT JOIN nodes AS above ON above.k = nodes.parent
"""

_SKETCH = SketchRules()

NEAR_DEDUP = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id,
  {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
sets AS (SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {_SKETCH.words} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(len(w) - {_SKETCH.words - 1}), lambda i: array_to_string(w[i + 1:i + {_SKETCH.words}], ' ')) END) AS s
  FROM docs),
shingles AS (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.r AS a, b.r AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= {_SKETCH.percent} * (a.n + b.n - count(*))),
reach AS (SELECT r, r AS other FROM sets UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.other),
named AS (SELECT reach.r, min(sets.doc_id) AS component FROM reach JOIN sets ON sets.r = reach.other GROUP BY reach.r)
SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN doc_id IS NOT NULL THEN component END AS component_id,
  coalesce(doc_id = component, true) AS kept FROM sets JOIN named USING (r)
"""

_SHARDS = ShardRules()

SHARDING = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) + {_SHARDS.overhead} AS size,
  {_crc32("coalesce(text, '')")} AS text_crc32 FROM documents, crc),
drawn AS (SELECT r, s, -ln((('0x' || left(md5(coalesce(doc_id::VARCHAR, '') || ':' || s), {DIGITS}))::BIGINT + 0.5)
  / {16 ** DIGITS}.0) AS score FROM docs, range({len(_SHARDS.weights) + 1}) t(s)),
won AS (SELECT r, arg_min(s, score) FILTER (s < {len(_SHARDS.weights)})::INT AS shard, arg_min(s, score)::INT AS grown_shard
  FROM drawn GROUP BY r)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM docs JOIN won USING (r)
"""

_RUNS = RunRules()

PERIODIC_RUNS = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w,
  {_crc32("coalesce(doc_id::VARCHAR, '')")} AS h FROM documents, crc),
sized AS (SELECT *, len(w)::BIGINT AS n, (h // 10)::BIGINT AS g FROM docs),
cut AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM sized),
again AS (SELECT r, doc_id, n, CASE WHEN a = n THEN w ELSE list_transform(range(n), lambda i:
  w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) END AS w FROM cut),
tokens AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM again),
pairs AS (SELECT a.r, a.i, b.i - a.i AS q FROM tokens a JOIN tokens b
  ON a.r = b.r AND a.word = b.word AND b.i > a.i AND {_RUNS.min_periods} * (b.i - a.i) <= a.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS part FROM pairs),
stretches AS (SELECT r, q, min(i) AS s, max(i) + 1 + q - min(i) AS length FROM islands GROUP BY r, q, part
  HAVING max(i) + 1 + q - min(i) >= greatest({_RUNS.min_length}, {_RUNS.min_periods} * q)),
runs AS (SELECT r, s, length, min(q) AS q FROM stretches GROUP BY r, s, length),
told AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM runs GROUP BY r),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / q DESC, s, q) = 1),
kept AS (SELECT tokens.r, string_agg(word, ' ' ORDER BY tokens.i) AS words FROM tokens
  WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.r = tokens.r AND tokens.i >= s + q AND tokens.i < s + length) GROUP BY tokens.r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, length::BIGINT AS length, q::BIGINT AS period,
  (1000 * length // q)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
  sha256(coalesce(words, '')) AS collapsed_sha256
FROM again LEFT JOIN told USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""

LLM_ORACLES = {
    "op3_chat_format": CHAT_FORMAT,
    "op4_line_dedup": LINE_DEDUP,
    "op5_near_dedup": NEAR_DEDUP,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_sharding": SHARDING,
    "op13_periodic_runs": PERIODIC_RUNS,
}
