"""DuckDB SQL for the queries of ``citegraph.llm.queries`` that SQL can express."""

from __future__ import annotations

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
escaped AS (
  SELECT *,
    replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') AS body,
    replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c') AS head
  FROM turns
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(4 + length(head) + 2 + length(body) + 8)::BIGINT AS formatted_chars,
  count(CASE WHEN role = 'assistant' THEN 1 END) AS n_examples
FROM escaped GROUP BY conv_id
"""

# Each rule's conditions for a bad and a good vote.
_RULES = (
    ("n_words < 50", "n_words >= 100"),
    ("word_chars > 15 * n_words OR word_chars < 2 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    ("10 * n_repeat_words > 3 * n_words", "10 * n_repeat_words <= n_words"),
    ("n_lines > 1 AND 10 * n_dup_lines > 3 * n_lines", "n_lines > 1 AND 10 * n_dup_lines <= n_lines"),
    ("10 * n_capitals > 3 * n_words", "10 * n_capitals <= n_words"),
    ("10 * n_marks > n_words", "50 * n_marks <= n_words"),
    ("20 * n_bars > n_words", "n_bars = 0"),
    ("10 * (n_symbols + n_marks) > word_chars", "50 * (n_symbols + n_marks) <= word_chars"),
    ("10 * n_distinct < 3 * n_words", "2 * n_distinct >= n_words"),
)
_ROUNDS = 12

_STATISTICS = r"""
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS MATERIALIZED (SELECT r, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
windows AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM
    (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM parts WHERE len(w) > 2)),
repeated AS (SELECT r, i FROM windows JOIN (SELECT r, a, b, c FROM windows GROUP BY ALL HAVING count(*) > 1) USING (r, a, b, c)),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
stats AS MATERIALIZED (SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x))) AS n_capitals,
    length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks, length(regexp_replace(t, '[^|]', '', 'g')) AS n_bars,
    len(list_distinct(w)) AS n_distinct
  FROM parts LEFT JOIN covered USING (r))"""


def _quality() -> str:
    """Votes, then the rounds of expectation-maximisation over the vote patterns, one after the other."""
    n = len(_RULES)
    names = ", ".join(f"v{i}" for i in range(n))
    cast = ", ".join(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 ELSE -1 END AS v{i}" for i, (bad, good) in enumerate(_RULES))
    steps = [
        _STATISTICS.strip(),
        f"voted AS MATERIALIZED (SELECT *, {cast} FROM stats)",
        f"patterns AS MATERIALIZED (SELECT {names}, count(*)::DOUBLE AS n FROM voted GROUP BY ALL)",
        f"p0 AS (SELECT *, CASE WHEN {' OR '.join(f'v{i} = 0' for i in range(n))} THEN 0.1::DOUBLE ELSE 0.9 END AS p FROM patterns)",
    ]
    for k in range(1, _ROUNDS + 1):
        sums = ["sum(n * p) AS g", "sum(n * (1 - p)) AS b"]
        for i in range(n):
            for v in (0, 1):
                sums += [f"coalesce(sum(n * {x}) FILTER (v{i} = {v}), 0) AS {c}{i}_{v}" for c, x in (("g", "p"), ("b", "(1 - p)"))]
        steps.append(f"s{k} AS MATERIALIZED (SELECT {', '.join(sums)} FROM p{k - 1})")
        odds = ["ln((g + 1) / (b + 1))"]
        for i in range(n):
            rate = lambda c, v, i=i: f"(({c}{i}_{v} + 1) / ({c}{i}_0 + {c}{i}_1 + 2))"
            odds.append(f"CASE v{i} WHEN 0 THEN ln({rate('g', 0)} / {rate('b', 0)}) WHEN 1 THEN ln({rate('g', 1)} / {rate('b', 1)}) ELSE 0 END")
        steps.append(f"p{k} AS MATERIALIZED (SELECT patterns.*, 1 / (1 + exp(-({' + '.join(odds)}))) AS p FROM patterns, s{k})")
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND p >= 0.5 AS kept
FROM voted JOIN p{_ROUNDS} USING ({names})"""


# Every kept term of a language against every group of it, absent or not, in whole numbers.
_DIVERGENCE = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
said AS MATERIALIZED (SELECT r, lang, source, unnest(terms) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term, count(*)::HUGEINT AS n FROM said GROUP BY ALL HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS MATERIALIZED (SELECT lang, source, term, count(*)::HUGEINT AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL),
shares AS MATERIALIZED (SELECT lang, source, term, coalesce(c.n, 0) AS n, k.n AS n_lang, l.v, l.total AS total_lang,
    1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.v) AS p
  FROM groups JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN counts c USING (lang, source, term) LEFT JOIN totals t USING (lang, source)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
      FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
owned AS (SELECT lang, source, term AS item, p, 1 + (1000000000 * (n_lang + 1)) // (total_lang + v) AS q FROM shares WHERE n > 0),
found AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, ((p - q) * (p - q)) // q FROM owned WHERE p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


# The checksum bit by bit, costs to go from the last row back, then the least path row by row.
_REPAIR = r"""
WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
faulty AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      flatten(list_transform(string_split(k, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) % 20 AS f FROM keyed),
damaged AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy FROM faulty WHERE f <> 0),
placed AS (SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS ini,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS last FROM damaged),
rows AS MATERIALIZED (SELECT *, coalesce(lag(ini) OVER w || ini NOT IN ('su', 'ua', 'au'), false) AS illegal,
    CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed WINDOW w AS (PARTITION BY c ORDER BY i)),
coded AS MATERIALIZED (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 1 ELSE 0 END AS stay FROM rows),
lengths AS (SELECT c, max(i) AS n FROM rows GROUP BY c),
togo AS (SELECT c, n + 1 AS i, [0, 4, 2, 0]::BIGINT[] AS v FROM lengths
  UNION ALL SELECT c, i, [least(b0, 2 + least(b2, 2 + b3)), least(b1, 2 + least(b2, 2 + b3)), least(b2, 2 + b3), least(b3, 2 + b2)]
  FROM (SELECT r.c, r.i,
      least(3 + v[1], 2 + stay + v[3], CASE ini WHEN 'u' THEN stay + v[3] WHEN 's' THEN stay + v[2] ELSE 1000000000 END) AS b0,
      least(3 + v[2], 2 + stay + v[3], CASE ini WHEN 'u' THEN stay + v[3] ELSE 1000000000 END) AS b1,
      least(3 + v[3], 2 + stay + v[4], CASE ini WHEN 'a' THEN stay + v[4] ELSE 1000000000 END) AS b2,
      least(3 + v[4], 2 + stay + v[3], CASE ini WHEN 'u' THEN stay + v[3] ELSE 1000000000 END) AS b3
    FROM togo g JOIN coded r ON r.c = g.c AND r.i = g.i - 1)),
costs AS MATERIALIZED (SELECT * FROM togo),
walk AS (SELECT c, 1::BIGINT AS i, 1 AS s, '' AS audit, []::VARCHAR[] AS lines FROM lengths
  UNION ALL SELECT c, CASE letter WHEN 'I' THEN i ELSE i + 1 END, CASE letter WHEN 'D' THEN s WHEN 'K' THEN kept ELSE led END, audit || letter,
    CASE letter WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
      ELSE list_append(lines, CASE led WHEN 3 THEN 'user' ELSE 'assistant' END || ':' || CASE letter WHEN 'R' THEN text ELSE '' END) END
  FROM (SELECT *, CASE WHEN role IS NOT NULL AND v[s] = 3 + nv[s] THEN 'D' WHEN v[s] = 2 + v[led] THEN 'I'
      WHEN kept > 0 AND v[s] = stay + nv[kept] THEN 'K' ELSE 'R' END AS letter
    FROM (SELECT w.*, g.v, h.v AS nv, r.role, r.text, r.stay, CASE w.s WHEN 3 THEN 4 ELSE 3 END AS led,
        CASE WHEN w.s = 1 AND ini = 's' THEN 2 WHEN w.s = 3 AND ini = 'a' THEN 4 WHEN w.s <> 3 AND ini = 'u' THEN 3 ELSE 0 END AS kept
      FROM walk w JOIN costs g ON g.c = w.c AND g.i = w.i LEFT JOIN costs h ON h.c = w.c AND h.i = w.i + 1
        LEFT JOIN coded r ON r.c = w.c AND r.i = w.i
      WHERE r.c IS NOT NULL OR g.v[w.s] > 0))),
ended AS (SELECT w.* FROM walk w JOIN lengths l ON w.c = l.c AND w.i = l.n + 1 AND w.s IN (1, 4)),
counted AS (SELECT conv_id, c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM rows GROUP BY conv_id, c)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(g.v[1], 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted k ON o.conv_id IS NOT DISTINCT FROM k.conv_id
  LEFT JOIN ended e ON e.c = k.c LEFT JOIN costs g ON g.c = k.c AND g.i = 1
"""


ORACLE = {"op13_conversation_repair": _REPAIR, "op12_divergence_audit": _DIVERGENCE, "op8_quality_rules": _quality(), "op10_chat_formatting": _CHAT}
