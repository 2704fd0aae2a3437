"""The named queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from .chat import op2_chat
from .decontamination import op4_decontaminate
from .fingerprints import op13_fingerprints
from .jaccard import op9_jaccard
from .language import op8_language
from .packing import op6_pack
from .periodic import op11_runs
from .quality import op1_quality
from .secrets import op7_secrets
from .suffix import op3_repeats
from .toxicity import op10_toxicity
from .variants import op12_variants
from .vectors import op5_vectors

QUERIES = {
    "op1_quality": op1_quality,
    "op2_chat": op2_chat,
    "op3_repeats": op3_repeats,
    "op4_decontaminate": op4_decontaminate,
    "op5_vectors": op5_vectors,
    "op6_pack": op6_pack,
    "op7_secrets": op7_secrets,
    "op8_language": op8_language,
    "op9_jaccard": op9_jaccard,
    "op10_toxicity": op10_toxicity,
    "op11_runs": op11_runs,
    "op12_variants": op12_variants,
    "op13_fingerprints": op13_fingerprints,
}

# SQL for DuckDB, where it can say the same; the others are tested against brute-force versions.

_LINKED = """
reach AS (SELECT id, id AS met FROM nodes UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.met),
roots AS (SELECT id, min(met) AS component_id FROM reach GROUP BY id),
degrees AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
"""
_CONTROL = r"<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|<\||\|>"

CHECKS: dict[str, str] = {
    "op2_chat": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(text) + 2 * len(regexp_extract_all(text, '{_CONTROL}'))
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 9 + length(role) END AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op5_vectors": f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y
  ON x.id <> y.id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.9),
{_LINKED}
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM roots LEFT JOIN degrees USING (id)""",
    "op9_jaccard": f"""
WITH RECURSIVE texts AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
nodes AS (
  SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM texts),
tokens AS (SELECT id, len(s) AS n, unnest(s) AS t FROM nodes),
links AS (
  SELECT x.id AS a, y.id AS b FROM tokens x JOIN tokens y ON x.t = y.t AND x.id <> y.id
  GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
{_LINKED}
SELECT nodes.id AS doc_id, len(s) AS n_shingles, component_id, coalesce(n, 0) AS n_links
FROM nodes JOIN roots ON roots.id = nodes.id LEFT JOIN degrees ON degrees.id = nodes.id""",
    # Equal words at every distance, in islands; crc32 bit by bit.
    "op11_runs": r"""
WITH hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) AS inverse
  FROM documents),
sized AS (SELECT doc_id, w, len(w)::BIGINT AS n, xor(inverse, 4294967295::BIGINT) AS h FROM hashed),
planned AS (SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a FROM sized),
texts AS (SELECT doc_id, n, CASE WHEN a < n THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[1 + a + (i - a) % (1 + (n - a) // (3 + g % 8))] END) ELSE w END AS w FROM planned),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS p FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i),
islands AS (SELECT doc_id, p, i, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM pairs),
spans AS (SELECT doc_id, p, min(i) AS s, max(i) + p + 1 AS e FROM islands GROUP BY doc_id, p, island HAVING count(*) >= greatest(p, 12 - p)),
runs AS (SELECT doc_id, s, e - s AS len, min(p) AS p FROM spans GROUP BY doc_id, s, e),
digests AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || p || chr(10), '' ORDER BY s, p) AS lines,
  min((-len, s, p)) AS best FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + p, s + len)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[2] AS start, -best[1] AS length, best[3] AS period, -best[1] * 1000 // best[3] AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN digests USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    # Near words share what is left after one of their letters is taken out.
    "op12_variants": r"""
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) AS crcs),
found AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{5,}')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS bytes FROM found GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, length(run) AS size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(bytes), 2), lambda k: ('0x' || bytes[k:k + 1])::BIGINT)),
    lambda crc, byte: xor(crcs[1 + (xor(crc, byte) & 255)], crc >> 8))) AS h
  FROM counted, steps),
slipped AS (SELECT CASE WHEN h % 97 = 0 THEN run[1:h % size] || run[h % size + 2:] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
shorter AS (SELECT word, n, k, word[1:k] || word[k + 2:] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)),
pairs AS (
  SELECT x.word, y.word AS other, y.n FROM shorter x JOIN shorter y ON x.rest = y.rest AND x.k = y.k AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM shorter x JOIN words y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM shorter x JOIN words y ON x.rest = y.word),
best AS (SELECT word, count(*) AS n_near, min((-n, other)) AS best FROM pairs GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * n THEN best[2] END AS form, CASE WHEN -best[1] >= 2 * n THEN -best[1] END AS form_n FROM words LEFT JOIN best USING (word)),
followed AS (SELECT word, word AS root, form AS ahead FROM formed UNION ALL
  SELECT x.word, y.word, y.form FROM followed x JOIN formed y ON x.ahead = y.word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM followed WHERE ahead IS NULL) USING (word)""",
}
