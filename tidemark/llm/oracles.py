"""DuckDB SQL with the rows of those queries that SQL can express; ids are taken to be unique, as in the given tables."""

from __future__ import annotations

import string

from tidemark.llm import chat, conversation_trie, hard_negatives
from tidemark.llm.quality_rules import Limits

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_FOLDED = rf"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+')"

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_FOLDED} ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) g FROM w),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY 1),
p AS (SELECT a.doc_id a, b.doc_id b, count(*) k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) n_shingles, CAST(least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS BIGINT) component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""

WARC = """
SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) payload_bytes, sha256(coalesce(html, '')) payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END record_type, CASE WHEN again THEN f END refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) f, octet_length(encode(coalesce(html, ''))) >= 100 AND page_id <> min(page_id) OVER (PARTITION BY coalesce(html, '')) again FROM pages)
"""


def quality_rules(limits: Limits = Limits()) -> str:
    most = max(*limits.top_share, *limits.repeat_share)
    top = " OR ".join(f"n = {n} AND top > {share}" for n, share in limits.top_share.items())
    repeat = " OR ".join(f"n = {n} AND cov > {share}" for n, share in limits.repeat_share.items())
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') text, {_WORDS} ws FROM documents),
w AS (SELECT doc_id, unnest(ws) word, unnest(range(1, len(ws) + 1)) i FROM d),
b AS (SELECT doc_id, CAST(len(ws) AS BIGINT) n_words, CAST(coalesce(list_sum([length(x) for x in ws]), 0) AS BIGINT) word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) n_symbols FROM d),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) line FROM d),
u AS (SELECT doc_id, line, count(*) - 1 again, coalesce(list_sum([length(x) for x in regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')]), 0) chars FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1, 2),
dl AS (SELECT doc_id, sum(again) n_dup_lines, sum(again * chars) dup_chars FROM u GROUP BY 1),
g AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) i, ws FROM d, (SELECT unnest(range(2, {most + 1})) n)),
c AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') gram FROM g),
t AS (SELECT *, count(*) OVER (PARTITION BY doc_id, n, gram) times FROM c),
covered AS (SELECT DISTINCT doc_id, n, i + k pos FROM t, (SELECT unnest(range(0, {most})) k) WHERE times > 1 AND k < n),
cov AS (SELECT v.doc_id, n, count(*) n_covered, sum(length(word)) chars FROM covered v JOIN w ON w.doc_id = v.doc_id AND w.i = v.pos GROUP BY 1, 2),
tops AS (SELECT doc_id, n, max(times * (length(gram) - n + 1)) chars FROM t WHERE times >= {limits.top_times} GROUP BY 1, 2),
bad AS (SELECT doc_id FROM (SELECT c.doc_id, n, c.chars / greatest(b.word_chars, 1) cov FROM cov c JOIN b ON b.doc_id = c.doc_id) WHERE {repeat}
  UNION SELECT doc_id FROM (SELECT c.doc_id, n, c.chars / greatest(b.word_chars, 1) top FROM tops c JOIN b ON b.doc_id = c.doc_id) WHERE {top}
  UNION SELECT dl.doc_id FROM dl JOIN b ON b.doc_id = dl.doc_id WHERE dup_chars / greatest(b.word_chars, 1) > {limits.line_share}),
r AS (SELECT b.*, CAST(coalesce(n_dup_lines, 0) AS BIGINT) n_dup_lines, CAST(coalesce(n_covered, 0) AS BIGINT) n_repeat_words FROM b LEFT JOIN dl ON dl.doc_id = b.doc_id LEFT JOIN cov ON cov.doc_id = b.doc_id AND cov.n = 3)
SELECT *, n_words < {limits.min_words} OR n_repeat_words > {limits.max_repeat_words} * n_words base_failed,
  NOT (n_words < {limits.min_words} OR n_repeat_words > {limits.max_repeat_words} * n_words) AND doc_id NOT IN (SELECT doc_id FROM bad) kept FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard_join": NGRAM_JOIN, "op5_quality_rules": quality_rules(), "op6_warc": WARC, "op10_chat_formatting": chat.ORACLE_SQL, "op12_hard_negatives": hard_negatives.ORACLE_SQL, "op13_conversation_trie": conversation_trie.ORACLE_SQL}
