"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

from tidemark.llm.url_trust import LINK

ORACLES: dict[str, str] = {}

ORACLES["op2_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, 8 + len(replace(regexp_replace(replace(role, '\', '\\'), '{pattern}', '\1\\\2', 'g'), chr(10), '<|line|>'))
    + 1 + len(regexp_replace(replace(text, '\', '\\'), '{pattern}', '\1\\\2', 'g')) + 8 AS chars
  FROM turns
), placed AS (
  SELECT *,
    sum(chars) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM escaped
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR nth = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

ORACLES["op10_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    len(coalesce(text, '')) - len(translate(coalesce(text, ''), '#*$%&|<>', '')) AS symbols,
    (CAST(('0x' || md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, ''))[:13]) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496.0::DOUBLE AS u
  FROM documents
), keyed AS (
  SELECT *, -ln(u) / (1.0::DOUBLE / (1.0::DOUBLE + 4.0::DOUBLE * symbols / greatest(size, 1))) AS key FROM docs
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, 3.0::DOUBLE * source_size AS room,
    CAST([5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS DOUBLE) AS weight
  FROM sizes
), rated AS (
  SELECT *, room / weight AS ratio, row_number() OVER by_ratio AS nth,
    (sum(source_size) OVER () - coalesce(sum(room) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (by_ratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM weighed WINDOW by_ratio AS (ORDER BY room / weight, weight, source NULLS LAST)
), plan AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR ratio <= level THEN room ELSE level * weight END AS target
  FROM rated, (SELECT arg_min(rate, nth) FILTER (rate <= ratio) AS level FROM rated)
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM plan
), ordered AS (
  SELECT d.*, source_size, target, epochs, target - epochs * source_size AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, u DESC, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM keyed d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, size, source_size, target,
  CAST(size * (epochs + CASE WHEN size > 0 AND 2 * start + size <= 2 * budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""

_PATTERN = r"([<\[])(/INST\]|/s>|INST\]|s>|\|assistant\|>|\|end\|>|\|endoftext\|>|\|im_end\|>|\|im_start\|>|\|line\|>|\|system\|>|\|turn\|>|\|user\|>|<SYS>>|</SYS>>)"
ORACLES["op2_chat_formatting"] = ORACLES["op2_chat_formatting"].replace("{pattern}", _PATTERN)

ORACLES["op1_url_filters"] = r"""
WITH RECURSIVE parsed AS (
  SELECT page_id, html, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), located AS (
  SELECT page_id, html, regexp_extract(rest, '^[^/?#]*') AS raw,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parsed
), hosted AS (
  SELECT page_id, html, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM located
), rules(said, rule_host, rule_path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), judged AS (
  SELECT h.*, (SELECT max({'n': length(rule_host || rule_path), 'rule': rule_host || rule_path, 'said': said}) FROM rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS fit
  FROM hosted h
), hosts AS (
  SELECT host, count(*) AS n, count(*) FILTER (fit.said = 'allow') AS allowed, count(*) FILTER (fit.said = 'block') AS blocked
  FROM judged WHERE host <> '' GROUP BY host
), seeds AS (
  SELECT 'trust' AS kind, host, allowed / n::DOUBLE AS weight FROM hosts WHERE allowed > 0
  UNION ALL SELECT 'distrust', host, blocked / n::DOUBLE FROM hosts WHERE blocked > 0
), edges AS (
  SELECT src, dst, count(*) AS n FROM (
    SELECT DISTINCT page_id, host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
    FROM judged WHERE host <> '') WHERE src <> dst AND dst <> '' GROUP BY src, dst
), directed AS (
  SELECT 'trust' AS kind, src, dst, n FROM edges UNION ALL SELECT 'distrust', dst, src, n FROM edges
), step AS (
  SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS share FROM directed
), state(round, kind, host, rank) AS (
  SELECT 0, kind, host, (1 - 0.85::DOUBLE) * weight FROM seeds
  UNION ALL
  SELECT round, kind, host, sum(rank) FROM (
    SELECT s.round + 1 AS round, s.kind, t.dst AS host, share * rank * 0.85::DOUBLE AS rank
    FROM state s JOIN step t ON s.kind = t.kind AND s.host = t.src
    UNION ALL SELECT r.round + 1, seeds.kind, seeds.host, (1 - 0.85::DOUBLE) * weight FROM (SELECT DISTINCT round FROM state) r, seeds
  ) WHERE round <= 200 GROUP BY round, kind, host
), ranks AS (
  SELECT kind, host, rank / sum(rank) OVER (PARTITION BY kind) AS share, sum(rank) OVER (PARTITION BY kind) AS whole
  FROM state WHERE round = 200
), everyone AS (
  SELECT host FROM hosts UNION SELECT dst FROM edges
), shares AS (
  SELECT e.host, round(coalesce(t.share, 0), 12) AS trust, round(coalesce(d.share, 0), 12) AS distrust,
    CASE WHEN 2 * h.allowed <= h.n THEN coalesce(h.allowed / h.n::DOUBLE * (1 - 0.85::DOUBLE) / t.whole, 0) ELSE 0 END AS own_trust,
    CASE WHEN 2 * h.blocked <= h.n THEN coalesce(h.blocked / h.n::DOUBLE * (1 - 0.85::DOUBLE) / d.whole, 0) ELSE 0 END AS own_distrust,
    (SELECT count(*) FROM everyone) AS n
  FROM everyone e LEFT JOIN hosts h ON h.host = e.host
    LEFT JOIN ranks t ON t.host = e.host AND t.kind = 'trust' LEFT JOIN ranks d ON d.host = e.host AND d.kind = 'distrust'
), verdicts AS (
  SELECT host, trust, distrust, n, round(trust - own_trust, 12) AS t, round(distrust - own_distrust, 12) AS d FROM shares
)
SELECT page_id, j.host, path, fit.rule AS rule,
  coalesce(fit.said, CASE WHEN d * n >= 0.5 AND d >= 0.5 * (t + d) AND d > 0 THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(trust, 0.0::DOUBLE) AS trust, coalesce(distrust, 0.0::DOUBLE) AS distrust
FROM judged j LEFT JOIN verdicts v ON v.host = j.host
""".replace("{link}", LINK.replace("'", "''"))

ORACLES["op12_fill_in_middle"] = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents
), drawn AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
    ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
    ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4
  FROM hashed
), cut AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
    array_to_string(units[b + 1:], '') AS suffix
  FROM cut
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
