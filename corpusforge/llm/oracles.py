"""DuckDB twins of the queries that SQL can express on whole tables."""

ORACLES: dict[str, str] = {}

ORACLES["op6_maxscore_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id) q
  JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLES["op1_tool_calls"] = r"""
WITH c AS (
  SELECT *, len(list_filter(string_split_regex(coalesce(text, ''), '[ \n]'), lambda w: w <> '')) AS words,
         CASE WHEN conv_id IS NOT NULL AND turn IS NOT NULL THEN conv_id::VARCHAR || '-' || turn::VARCHAR END AS here,
         CASE WHEN conv_id IS NOT NULL AND turn IS NOT NULL THEN conv_id::VARCHAR || '-' || (turn - 1)::VARCHAR END AS above
  FROM conversations
), call0 AS (
  SELECT conv_id, here AS call_id, turn, CASE WHEN words <= 20 THEN 'lookup' WHEN words <= 40 THEN 'search' ELSE 'compose' END AS name,
         '{' || CASE WHEN text IS NULL THEN '' ELSE '"text":' || to_json(text) || ',' END || '"turn":' || turn || ',"words":' || words || '}' AS args,
         text IS NOT NULL AND CASE WHEN words <= 20 THEN words >= 1 AND length(text) <= 120
                                   WHEN words <= 40 THEN length(text) >= 20 ELSE words <= 60 END AS valid
  FROM c WHERE role = 'user'
), call1 AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn, name, args) AS k,
         count(*) OVER (PARTITION BY conv_id, call_id) AS copies FROM call0
), res AS (
  SELECT conv_id, above AS call_id, turn, text AS content,
         row_number() OVER (PARTITION BY conv_id, above ORDER BY turn, text NULLS FIRST) AS k,
         count(*) OVER (PARTITION BY conv_id, above) AS n FROM c WHERE role NOT IN ('user', 'system')
), call AS (
  SELECT c1.*, row_number() OVER (PARTITION BY c1.conv_id ORDER BY c1.turn, c1.call_id) - 1 AS seq, r.turn AS rturn, r.content,
         coalesce(r.n, 0) AS n_results
  FROM call1 c1 LEFT JOIN res r ON r.conv_id = c1.conv_id AND r.call_id = c1.call_id AND r.k = 1
  WHERE c1.k = 1 AND c1.call_id IS NOT NULL
)
SELECT 'call' AS kind, conv_id, call_id, turn, seq, name, valid, n_results,
       '{"arguments":' || args || ',"call_id":' || to_json(call_id) || ',"name":"' || name || '"'
       || CASE WHEN n_results = 0 THEN '' ELSE ',"result":{' || CASE WHEN content IS NULL THEN '' ELSE '"content":' || to_json(content) || ',' END
               || '"turn":' || rturn || '}' END
       || ',"seq":' || seq || ',"turn":' || turn || ',"valid":' || valid || '}' AS json
FROM call
UNION ALL
SELECT 'duplicate_call', conv_id, call_id, turn, seq, name, valid, copies - 1, NULL FROM call WHERE copies > 1
UNION ALL
SELECT 'orphan_result', r.conv_id, r.call_id, r.turn, NULL, NULL, FALSE, 0,
       '{"call_id":' || to_json(r.call_id) || CASE WHEN r.content IS NULL THEN '' ELSE ',"content":' || to_json(r.content) END || ',"turn":' || r.turn || '}'
FROM res r WHERE NOT EXISTS (SELECT 1 FROM call c WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id)
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    step = ("list_reduce(list_concat([xor(c, x)], [0, 0, 0, 0, 0, 0, 0, 0]), "
            "lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)")
    return (f"xor(list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)), "
            f"lambda c, x: {step}), 4294967295)")


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_FOLD = "sha256(CASE WHEN f.pos % 2 = 1 THEN coalesce(s.digest, '') || f.digest ELSE f.digest || coalesce(s.digest, '') END)"

ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS cnt,
         row_number() OVER () AS rid
  FROM (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
               CASE WHEN doc_id IS NOT NULL AND n_chars IS NOT NULL AND {_crc32('doc_id::VARCHAR')} % 7 = 0
                    THEN {_leaf('(n_chars::HUGEINT + 1)')} END AS other FROM documents)
), t AS (
  SELECT lang, 0 AS lev, pos, leaf AS digest, cnt FROM d
  UNION ALL
  SELECT lang, lev + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (cnt + 1) // 2 FROM t WHERE cnt > 1 GROUP BY lang, lev, pos // 2, cnt
), sub AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS cnt FROM t WHERE cnt = 1
), u AS (
  SELECT 0 AS lev, pos, digest, cnt FROM sub
  UNION ALL
  SELECT lev + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (cnt + 1) // 2 FROM u WHERE cnt > 1 GROUP BY lev, pos // 2, cnt
), f AS (
  SELECT rid, lang, 0 AS lev, pos, cnt, coalesce(other, leaf) AS digest, '' AS proof FROM d
  UNION ALL
  SELECT f.rid, f.lang, f.lev + 1, f.pos // 2, (f.cnt + 1) // 2, {_FOLD}, f.proof || coalesce(s.digest, '')
  FROM f LEFT JOIN t s ON s.lang IS NOT DISTINCT FROM f.lang AND s.lev = f.lev AND s.pos = xor(f.pos, 1)
  WHERE f.cnt > 1
), g AS (
  SELECT f.rid, 0 AS lev, sub.pos, sub.cnt, f.digest, f.proof FROM f JOIN sub ON sub.lang IS NOT DISTINCT FROM f.lang WHERE f.cnt = 1
  UNION ALL
  SELECT f.rid, f.lev + 1, f.pos // 2, (f.cnt + 1) // 2, {_FOLD}, f.proof || coalesce(s.digest, '')
  FROM g f LEFT JOIN u s ON s.lev = f.lev AND s.pos = xor(f.pos, 1)
  WHERE f.cnt > 1
)
SELECT d.doc_id, d.leaf, sub.digest AS subroot, r.digest AS root, sha256(g.proof) AS proof_sha256, g.digest AS folded_root,
       g.digest = r.digest AS verified
FROM d JOIN g ON g.rid = d.rid AND g.cnt = 1 JOIN sub ON sub.lang IS NOT DISTINCT FROM d.lang CROSS JOIN (SELECT digest FROM u WHERE cnt = 1) r
"""

# The states of the pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a.  Column qN is the best way into
# state N: {cost, audit, lines}, null for none.  The twin walks the rows once from left to right.
_WS = r"[\x20\x09-\x0D]"
_BEST = "NULL::STRUCT(cost INTEGER, audit VARCHAR, lines VARCHAR[])"


def _least(*options: str) -> str:
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))"


def _edit(state: str, cost: str, letter: str, line: str | None) -> str:
    lines = f"{state}.lines" if line is None else f"list_append({state}.lines, {line})"
    return (f"CASE WHEN {state} IS NOT NULL THEN {{'cost': ({state}.cost + {cost})::INTEGER, 'audit': {state}.audit || '{letter}', "
            f"'lines': {lines}}} END")


def _closed(source: str) -> str:
    """``source`` with insertions: a user turn, an assistant turn, a user turn (more never pay)."""
    one = f"SELECT * REPLACE ({_least('q2', *[_edit(f'q{i}', '2', 'I', chr(39) + 'user:' + chr(39)) for i in (0, 1, 3)])} AS q2) FROM {source}"
    two = f"SELECT * REPLACE ({_least('q3', _edit('q2', '2', 'I', chr(39) + 'assistant:' + chr(39)))} AS q3) FROM ({one})"
    return f"(SELECT * REPLACE ({_least('q2', _edit('q3', '2', 'I', chr(39) + 'user:' + chr(39)))} AS q2) FROM ({two}))"


def _move(to: int) -> str:
    """State ``to`` behind the row ``x``: delete, keep or rerole."""
    options = [_edit(f"q{to}", "3", "D", None)]
    initial, role, before = {0: ("", "", ()), 1: ("s", "", (0,)), 2: ("u", "user", (0, 1, 3)), 3: ("a", "assistant", (2,))}[to]
    for p in before:
        options.append(f"CASE WHEN ok AND i = '{initial}' THEN {_edit(f'q{p}', 't', 'K', 'role || chr(58) || text')} END")
        if role:
            turn = f"'{role}:' || text"
            options.append(f"CASE WHEN ok THEN {_edit(f'q{p}', '(2 + t)', 'R', turn)} END")
    return _least(*options)


_STEP = f"""(
    SELECT w.conv_id, x.pos, {', '.join(f'{_move(q)} AS q{q}' for q in range(4))}
    FROM walk w JOIN (SELECT *, fate IN ('fine', 'truncated') AS ok, CASE WHEN fate = 'truncated' THEN 1 ELSE 0 END AS t FROM faults) x
      ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.pos = w.pos + 1)"""

ORACLES["op13_dialog_repair"] = rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS f
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE f <> 0)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 256), sha256(text)) AS pos,
         regexp_replace(text, '{_WS}+$', '') AS ended, left(role, 1) AS i FROM hurt
), earliest AS (
  SELECT conv_id, role, text, min(pos) AS pos FROM placed GROUP BY ALL
), faults AS (
  SELECT p.*, CASE WHEN ended = '' THEN 'blank' WHEN f.pos < p.pos THEN 'duplicate'
                   WHEN right(ended, 1) IN ('.', '!', '?') THEN 'fine' ELSE 'truncated' END AS fate,
         i || lead(i) OVER (PARTITION BY p.conv_id ORDER BY p.pos) AS pair
  FROM placed p JOIN earliest f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.role = p.role AND f.text = p.text
), facts AS (
  SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fate = 'blank') AS blank, count(*) FILTER (fate = 'duplicate') AS duplicate,
         count(*) FILTER (fate = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), start AS (
  SELECT conv_id, 0::BIGINT AS pos, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}}::STRUCT(cost INTEGER, audit VARCHAR, lines VARCHAR[]) AS q0,
         {_BEST} AS q1, {_BEST} AS q2, {_BEST} AS q3
  FROM facts
), walk AS (
  SELECT conv_id, pos, q0, q1, q2, q3 FROM {_closed('start')}
  UNION ALL
  SELECT conv_id, pos, q0, q1, q2, q3 FROM {_closed(_STEP)}
), done AS (
  SELECT f.*, {_least('w.q0', 'w.q3')} AS best FROM facts f JOIN walk w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.pos = f.n
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""
