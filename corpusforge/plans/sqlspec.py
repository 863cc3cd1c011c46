"""The same relational plans written as plain SQL for DuckDB (the independent oracle).

Each function returns a SQL expression or a ``WITH``-chain fragment over the driver's
pre-registered views.  They are built from the same fixed literals as the Spark code, so
a mismatch always means a semantic difference, never a typo in a constant.
"""

from __future__ import annotations

from corpusforge.functions import text as tx
from corpusforge.functions.hashing import hash48_sql, unit_sql
from corpusforge.operators.dedup import MERSENNE31, ROLL_BASE, lsh_params, minhash_params
from corpusforge.sources.tables import LABELS, NOISE_PREFIXES, NOISE_SUFFIXES


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(q(x) for x in items) + "]"


def noisy_documents() -> str:
    k = f"(doc_id % {len(NOISE_PREFIXES)}) + 1"
    return (f"SELECT doc_id, {_list(NOISE_PREFIXES)}[{k}] || text || {_list(NOISE_SUFFIXES)}[{k}] AS text, "
            f"lang, source FROM documents")


# text ------------------------------------------------------------------------------------
def collapse_whitespace(e: str) -> str:
    return f"trim(regexp_replace({e}, {q(tx.WHITESPACE_CLASS + '+')}, ' ', 'g'), ' ')"


def repair_mojibake(e: str) -> str:
    for bad, good in tx.MOJIBAKE_REPLACEMENTS:
        e = f"replace({e}, {q(bad)}, {q(good)})"
    return e


def remove_zero_width(e: str) -> str:
    cls = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in tx.ZERO_WIDTH_CHARS) + "]"
    return f"regexp_replace({e}, {q(cls)}, '', 'g')"


def normalize_quotes(e: str) -> str:
    cls = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in tx.QUOTE_CHARS) + "]"
    return f"regexp_replace({e}, {q(cls)}, '\"', 'g')"


def remove_boilerplate_single(e: str) -> str:
    pat = r"^(thanks for reading|#hiring([^\p{L}\p{N}_]|$))"
    return f"CASE WHEN regexp_matches({e}, {q(pat)}, 'i') THEN '' ELSE {e} END"


def clean_text(e: str, boilerplate: bool = False) -> str:
    c = normalize_quotes(remove_zero_width(repair_mojibake(collapse_whitespace(e))))
    return remove_boilerplate_single(c) if boilerplate else c


def emoji_count(e: str) -> str:
    return f"len(regexp_extract_all({e}, {q(tx.EMOJI_CLASS)}))"


def word_count(e: str) -> str:
    return f"len(regexp_extract_all({e}, {q(tx.WORD_TOKEN)}))"


def word_tokens(e: str) -> str:
    return f"regexp_extract_all(lower({e}), {q(tx.WORD_TOKEN)})"


def emoji_density(e: str, normalization: str = "per_word") -> str:
    denom = f"length({e})" if normalization == "per_char" else word_count(e)
    return f"round_even({emoji_count(e)} / greatest(1, {denom}), 6)"


# dedup -----------------------------------------------------------------------------------
def word_shingles(w: str, n: int = 5) -> str:
    """Shingles from an already computed token list column ``w``."""
    return (f"list_distinct(list_transform(range(1, greatest(1, len({w}) - {n} + 1) + 1), "
            f"lambda i: array_to_string({w}[i:i + {n - 1}], ' ')))")


def char_normalize(e: str) -> str:
    return f"regexp_replace(lower({e}), {q(tx.WHITESPACE_CLASS + '+')}, ' ', 'g')"


def char_shingles(t: str, n: int = 5) -> str:
    """Shingles from an already normalised text column ``t``."""
    return (f"list_distinct(list_transform(range(1, greatest(1, length({t}) - {n} + 1) + 1), "
            f"lambda i: substring({t}, i, {n})))")


def shingles_cte(name: str, src: str, id_col: str, text_expr: str, n: int = 5, level: str = "word",
                 where: str = "TRUE") -> str:
    """``name(id, s)``: the distinct shingle list per row, tokenised once in a materialised CTE."""
    prep = char_normalize("t") if level == "char" else word_tokens("t")
    sh = char_shingles("w", n) if level == "char" else word_shingles("w", n)
    return f"""
{name}_tok AS MATERIALIZED (SELECT id, {prep} AS w FROM (SELECT {id_col} AS id, {text_expr} AS t FROM {src})
                            WHERE {where}),
{name} AS (SELECT id, {sh} AS s FROM {name}_tok)"""


def perms_table(num_perm: int = 128, seed: int = 1) -> str:
    """Multiply-shift coefficients split into 32-bit halves so the hash stays in BIGINT:
    ((a x + b) mod 2^64) >> 32 = ((ah x mod 2^32) + bh + ((al x + bl) >> 32)) mod 2^32."""
    a, b = minhash_params(num_perm, seed)
    m = (1 << 32) - 1
    rows = ", ".join(f"({i}, {a[i] >> 32}, {a[i] & m}, {b[i] >> 32}, {b[i] & m})" for i in range(num_perm))
    return f"SELECT * FROM (VALUES {rows}) AS t(perm, ah, al, bh, bl)"


def minhash_ctes(src: str, id_col: str, text_expr: str, *, num_perm: int = 128, n_gram: int = 5,
                 level: str = "word", seed: int = 1, prefix: str = "mh") -> str:
    """CTE ``{prefix}_sig(id, perm, mh)`` for the non-empty texts of ``src``: token hashes,
    Horner shingle hashes, multiply-shift min-hashes (see corpusforge.operators.dedup)."""
    if level == "char":
        toks = f"list_transform(regexp_extract_all({char_normalize('t')}, '(?s).'), lambda c: unicode(c)::BIGINT + 1)"
    else:
        toks = f"list_transform({word_tokens('t')}, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT % {MERSENNE31})"
    n = n_gram
    horner = (f"list_reduce(list_prepend(0::BIGINT, th[i:i + {n - 1}]), "
              f"lambda acc, v: (acc * {ROLL_BASE} + v) % {MERSENNE31})")
    return f"""
{prefix}_tok AS MATERIALIZED (SELECT id, {toks} AS th FROM (SELECT {id_col} AS id, {text_expr} AS t FROM {src})
                              WHERE t IS NOT NULL AND length(t) > 0),
{prefix}_x AS (SELECT id, unnest(list_transform(range(1, greatest(1, len(th) - {n} + 1) + 1), lambda i: {horner})) AS x
               FROM {prefix}_tok),
{prefix}_perm AS ({perms_table(num_perm, seed)}),
{prefix}_sig AS (SELECT id, perm, min((ah * x % 4294967296 + bh + ((al * x + bl) >> 32)) % 4294967296) AS mh
                 FROM {prefix}_x CROSS JOIN {prefix}_perm GROUP BY id, perm)"""


def lsh_member_ctes(threshold: float = 0.9, num_perm: int = 128, prefix: str = "mh") -> str:
    """CTE ``{prefix}_mem(band, first, node)`` from ``{prefix}_sig``."""
    bands, rows = lsh_params(threshold, num_perm)
    return f"""
{prefix}_band AS (SELECT id, perm // {rows} AS band, list(mh ORDER BY perm) AS k
                  FROM {prefix}_sig WHERE perm < {bands * rows} GROUP BY id, perm // {rows}),
{prefix}_bucket AS (SELECT band, k, min(id) AS first FROM {prefix}_band GROUP BY band, k HAVING count(*) >= 2),
{prefix}_mem AS (SELECT b.band, u.first, b.id AS node FROM {prefix}_band b JOIN {prefix}_bucket u
                 ON b.band = u.band AND b.k = u.k)"""


def keep_first_ctes(prefix: str = "mh") -> str:
    """CTE ``{prefix}_dropped(node)``: a sequential walk over the bucket members in order.
    State: the buckets already holding a kept row; a row is dropped iff one of its buckets
    is in that list, else it is kept and closes all of its buckets (no pairs are built)."""
    return f"""
{prefix}_nodes AS (SELECT node, row_number() OVER (ORDER BY node) AS rn FROM (SELECT DISTINCT node FROM {prefix}_mem)),
{prefix}_nb AS (SELECT node, list(band::BIGINT * 1099511627776 + first) AS bks FROM {prefix}_mem GROUP BY node),
{prefix}_walk AS (
  SELECT 0::BIGINT AS rn, []::BIGINT[] AS closed, []::BIGINT[] AS dropped
  UNION ALL
  SELECT w.rn + 1,
         CASE WHEN list_has_any(w.closed, nb.bks) THEN w.closed ELSE list_concat(w.closed, nb.bks) END,
         CASE WHEN list_has_any(w.closed, nb.bks) THEN list_append(w.dropped, n.node) ELSE w.dropped END
  FROM {prefix}_walk w JOIN {prefix}_nodes n ON n.rn = w.rn + 1 JOIN {prefix}_nb nb ON nb.node = n.node),
{prefix}_final AS (SELECT dropped FROM {prefix}_walk ORDER BY rn DESC LIMIT 1),
{prefix}_dropped AS (SELECT unnest(dropped) AS node FROM {prefix}_final)"""


def verified_keep_first_ctes(src: str, id_col: str, text_expr: str, threshold: float = 0.9, prefix: str = "mh") -> str:
    """CTE ``{prefix}_vdropped(node)``: keep-first over pairs that share a bucket and whose whole
    shingle sets are similar (no rounds: all pairs of a bucket, then a walk in order)."""
    sets = shingles_cte(f"{prefix}_vs", src, id_col, text_expr, where="t IS NOT NULL AND length(t) > 0").strip()
    sets = sets.replace(f"{prefix}_vs AS (SELECT", f"{prefix}_vs AS MATERIALIZED (SELECT")
    return f"""
{sets},
{prefix}_vp AS MATERIALIZED (SELECT DISTINCT a.node AS a, b.node AS b FROM {prefix}_mem a JOIN {prefix}_mem b
                ON a.band = b.band AND a.first = b.first AND a.node < b.node),
{prefix}_vi AS MATERIALIZED (SELECT a, b, len(list_intersect(x.s, y.s)) AS i, len(x.s) AS n, len(y.s) AS m
                FROM {prefix}_vp JOIN {prefix}_vs x ON x.id = a JOIN {prefix}_vs y ON y.id = b),
{prefix}_ve AS MATERIALIZED (SELECT b AS node, list(a) AS earlier, row_number() OVER (ORDER BY b) AS rn FROM {prefix}_vi
                WHERE i::DOUBLE / (n + m - i) >= {threshold!r}::DOUBLE GROUP BY b),
{prefix}_vwalk AS (
  SELECT 0::BIGINT AS rn, []::BIGINT[] AS dropped
  UNION ALL
  SELECT w.rn + 1, CASE WHEN len(list_filter(e.earlier, lambda x: NOT list_contains(w.dropped, x))) > 0
                        THEN list_append(w.dropped, e.node) ELSE w.dropped END
  FROM {prefix}_vwalk w JOIN {prefix}_ve e ON e.rn = w.rn + 1),
{prefix}_vdropped AS (SELECT unnest(dropped) AS node FROM (SELECT dropped FROM {prefix}_vwalk ORDER BY rn DESC LIMIT 1))"""


# labels / splits -------------------------------------------------------------------------
def label_probs() -> str:
    parts = " UNION ALL ".join(
        f"SELECT doc_id AS row_id, {q(n)} AS label, CAST({n} AS INTEGER) AS y FROM labels" for n in LABELS)
    return (f"SELECT row_id, label, y, round_even(0.6::DOUBLE * {unit_sql('row_id', 'label')} "
            f"+ 0.4::DOUBLE * y, 6) AS p FROM ({parts})")


def shuffle_key(e: str, seed: int = 42) -> str:
    return hash48_sql(e, "'split'", str(seed))


def random_split_ctes(rows_cte: str, val_ratio: float = 0.15, test_ratio: float = 0.15, seed: int = 42,
                      prefix: str = "rs") -> str:
    """CTE ``{prefix}_out(row_id, split)`` for ``rows_cte(row_id)``."""
    return f"""
{prefix}_r AS (SELECT row_id, row_number() OVER (ORDER BY {shuffle_key('row_id', seed)}, row_id) AS rn,
                      count(*) OVER () AS n FROM {rows_cte}),
{prefix}_out AS (SELECT row_id, CASE WHEN rn <= floor(n * {test_ratio!r}::DOUBLE) THEN 'test'
                     WHEN rn <= floor(n * {test_ratio!r}::DOUBLE) + floor(n * {val_ratio!r}::DOUBLE) THEN 'val'
                     ELSE 'train' END AS split FROM {prefix}_r)"""


def stratified_split_ctes(rows_cte: str, probs_cte: str, labels=LABELS, val_ratio: float = 0.15,
                          test_ratio: float = 0.15, seed: int = 42, prefix: str = "ss") -> str:
    """CTE ``{prefix}_out(row_id, split)``; ``rows_cte(row_id, has_labels)``, ``probs_cte(row_id, label, p)``."""
    lab = ", ".join(q(x) for x in labels)
    key = shuffle_key("row_id", seed)
    return f"""
{prefix}_rows AS (SELECT row_id, has_labels, {key} AS key FROM {rows_cte}),
{prefix}_n AS (SELECT count(*) AS n, floor(count(*) * {test_ratio!r}::DOUBLE) AS n_test,
                      floor(count(*) * {val_ratio!r}::DOUBLE) AS n_val FROM {prefix}_rows),
{prefix}_pos AS (SELECT p.row_id, p.label, r.key FROM {probs_cte} p JOIN {prefix}_rows r ON p.row_id = r.row_id
                 WHERE r.has_labels AND p.p >= 0.5 AND p.label IN ({lab})),
{prefix}_tg AS (SELECT label, greatest(1, floor(count(*) * {val_ratio!r}::DOUBLE)) AS t_val,
                       greatest(1, floor(count(*) * {test_ratio!r}::DOUBLE)) AS t_test FROM {prefix}_pos GROUP BY label),
{prefix}_need_t AS (SELECT DISTINCT row_id, key FROM (
      SELECT p.row_id, p.key, row_number() OVER (PARTITION BY p.label ORDER BY p.key, p.row_id) AS rk, t.t_test
      FROM {prefix}_pos p JOIN {prefix}_tg t ON p.label = t.label) WHERE rk <= t_test),
{prefix}_test AS (SELECT row_id FROM (SELECT row_id, row_number() OVER (ORDER BY key, row_id) AS rk FROM {prefix}_need_t),
                  {prefix}_n WHERE rk <= n_test),
{prefix}_pos2 AS (SELECT * FROM {prefix}_pos WHERE row_id NOT IN (SELECT row_id FROM {prefix}_test)),
{prefix}_need_v AS (SELECT DISTINCT row_id, key FROM (
      SELECT p.row_id, p.key, row_number() OVER (PARTITION BY p.label ORDER BY p.key, p.row_id) AS rk, t.t_val
      FROM {prefix}_pos2 p JOIN {prefix}_tg t ON p.label = t.label) WHERE rk <= t_val),
{prefix}_val AS (SELECT row_id FROM (SELECT row_id, row_number() OVER (ORDER BY key, row_id) AS rk FROM {prefix}_need_v),
                 {prefix}_n WHERE rk <= n_val),
{prefix}_out AS (SELECT r.row_id, CASE WHEN r.row_id IN (SELECT row_id FROM {prefix}_test) THEN 'test'
                                       WHEN r.row_id IN (SELECT row_id FROM {prefix}_val) THEN 'val'
                                       ELSE 'train' END AS split FROM {prefix}_rows r)"""


# derived judge answers ---------------------------------------------------------------
def judge_samples() -> str:
    from corpusforge.sources.tables import JUDGES, SAMPLES
    u_miss = unit_sql("row_id", "label", "judge_no", "sample_no", "'miss'")
    u_val = unit_sql("row_id", "label", "judge_no", "sample_no")
    return f"""SELECT row_id, judge_no::INTEGER AS judge_no, sample_no::INTEGER AS sample_no, label,
       CASE WHEN {u_miss} < 0.1 THEN NULL ELSE round_even(p + 0.3::DOUBLE * ({u_val} - 0.5::DOUBLE), 6) END AS prob
FROM (SELECT row_id, label, p FROM ({label_probs()})
      UNION ALL SELECT DISTINCT row_id, 'overall', round_even({unit_sql('row_id', "'overall'")}, 6) FROM ({label_probs()})) b,
     range({JUDGES}) j(judge_no), range({SAMPLES}) s(sample_no)"""


def judge_sample_fields() -> str:
    from corpusforge.sources.tables import JUDGES, SAMPLES
    key = ["row_id", "judge_no", "sample_no"]
    u = lambda tag: unit_sql(*key, tag)
    md5 = "substr(md5(concat_ws(':', CAST(row_id AS VARCHAR), CAST(judge_no AS VARCHAR), CAST(sample_no AS VARCHAR))), 1, 6)"
    return f"""SELECT row_id, judge_no::INTEGER AS judge_no, sample_no::INTEGER AS sample_no,
       ({word_tokens('text')})[sample_no + 1:sample_no + 3] AS reasons,
       CASE WHEN {u("'r'")} < 0.5 THEN '' ELSE 'r' || CAST(sample_no AS VARCHAR) || '-' || {md5} END AS rationale,
       floor({u("'c'")} * 25)::BIGINT AS count,
       {u("'f'")} >= 0.5 AS flag
FROM (SELECT l.doc_id AS row_id, d.text FROM labels l JOIN documents d ON l.doc_id = d.doc_id) b,
     range({JUDGES}) j(judge_no), range({SAMPLES}) s(sample_no)"""


def given_labels(flip_rate: float = 0.05) -> str:
    return (f"SELECT row_id, label, CASE WHEN {unit_sql('row_id', 'label', chr(39) + 'flip' + chr(39))} < {flip_rate!r} "
            f"THEN 1 - y ELSE y END AS y FROM ({label_probs()})")


def label_issues_ctes(given_cte: str, probs_cte: str, prefix: str = "cl") -> str:
    """CTE ``{prefix}_issues(row_id, label)``: confident learning, prune by noise rate."""
    return f"""
{prefix}_d AS (SELECT g.row_id, g.label, g.y AS s, p.p AS p1, 1.0 - p.p AS p0
               FROM {given_cte} g JOIN {probs_cte} p ON g.row_id = p.row_id AND g.label = p.label),
{prefix}_t AS (SELECT label, avg(p1) FILTER (WHERE s = 1) AS t1, avg(p0) FILTER (WHERE s = 0) AS t0
               FROM {prefix}_d GROUP BY label),
{prefix}_c AS (SELECT d.*, CASE WHEN p1 >= t1 AND p0 >= t0 THEN (CASE WHEN p1 > p0 THEN 1 ELSE 0 END)
                                WHEN p1 >= t1 THEN 1 WHEN p0 >= t0 THEN 0 END AS c
               FROM {prefix}_d d JOIN {prefix}_t t ON d.label = t.label),
{prefix}_j AS (SELECT label, s, c, count(*) AS n FROM {prefix}_c WHERE c IS NOT NULL GROUP BY ALL),
{prefix}_k AS (SELECT j.label, j.s, round_even(j.n * g.n_given / r.n_row, 0)::BIGINT AS k
               FROM {prefix}_j j
               JOIN (SELECT label, s, sum(n) AS n_row FROM {prefix}_j GROUP BY ALL) r ON j.label = r.label AND j.s = r.s
               JOIN (SELECT label, s, count(*) AS n_given FROM {prefix}_d GROUP BY ALL) g ON j.label = g.label AND j.s = g.s
               WHERE j.s <> j.c),
{prefix}_r AS (SELECT row_id, label, s, row_number() OVER (PARTITION BY label, s ORDER BY
                 floor((1.0 - CASE WHEN s = 1 THEN p0 - p1 ELSE p1 - p0 END) * {float(2 ** 46)!r})::BIGINT, row_id) AS rk
               FROM {prefix}_d),
{prefix}_issues AS (SELECT r.row_id, r.label FROM {prefix}_r r JOIN {prefix}_k k ON r.label = k.label AND r.s = k.s
                    WHERE r.rk <= k.k)"""


def judgment_scores() -> str:
    return (f"SELECT DISTINCT row_id, 'overall' AS label, round_even({unit_sql('row_id', chr(39) + 'overall' + chr(39))}, 6) AS p "
            f"FROM ({label_probs()}) UNION ALL SELECT row_id, label, p FROM ({label_probs()})")


def recorded_comparisons(pairs_cte: str) -> str:
    own = lambda x: f"CASE WHEN p.label = 'toxic' THEN {x}.toxic ELSE {x}.quality END"
    return f"""SELECT label, id_a, id_b, CASE WHEN ya > yb THEN 'A' WHEN ya < yb THEN 'B' ELSE 'tie' END AS preferred,
    CASE WHEN ya = yb THEN 'unsure' ELSE '1.0' END AS confidence_raw, 'labelled ' || ya || ' and ' || yb AS reason
    FROM (SELECT p.label, p.id_a, p.id_b, {own('a')} AS ya, {own('b')} AS yb FROM {pairs_cte} p
          JOIN labels a ON a.doc_id = p.id_a JOIN labels b ON b.doc_id = p.id_b)"""


# generation plan ---------------------------------------------------------------------
def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return q(str(v))


def _pick(values, idx: str) -> str:
    return f"[{', '.join(_sql_lit(v) for v in values)}][({idx}) + 1]"


def weighted_index(u: str, weights) -> str:
    total = sum(weights)
    cum, whens = 0.0, []
    for i, w in enumerate(weights):
        cum += w
        whens.append(f"WHEN {u} * {float(total)!r} <= {cum!r} THEN {i}")
    return f"(CASE {' '.join(whens)} ELSE {len(weights) - 1} END)"


def clean_tags(e: str) -> str:
    return f"list_transform(list_filter({e}, lambda t: trim(t) <> ''), lambda t: lower(ltrim(t, '#')))"


def plan_sql(cfg, ids_sql: str, seed: int = 42, overrides: dict | None = None) -> str:
    """SQL twin of :func:`corpusforge.operators.planning.plan` over ``ids_sql(id)``."""
    from corpusforge.operators.planning import KNOB_DEFAULTS, SEED_MAX, cycle_order
    ov = dict(overrides or {})
    u = lambda t: unit_sql("id", q(t), str(seed))
    names = [s[0] for s in cfg.styles]
    n = len(names)
    if cfg.ensure_label_coverage:
        items = ", ".join(f"{{'h': {hash48_sql('id // ' + str(n), q('epoch-style'), q(nm), str(seed))}, 'i': {i}}}"
                          for i, nm in enumerate(names))
        si = f"(list_sort([{items}])[(id % {n}) + 1]).i"
    elif cfg.shuffle_styles:
        si = f"[{', '.join(str(i) for i in cycle_order(names, seed))}][(id % {n}) + 1]"
    else:
        si = weighted_index(u("style"), [s[2] for s in cfg.styles])

    def preset(k):
        vals = [s[1].get(k) for s in cfg.styles]
        return _pick(vals, si) if any(v is not None for v in vals) else "NULL"

    def choose(items, key, fallback):
        o = ov.get(key)
        if o and o in items:
            return q(o)
        if items:
            return _pick(items, f"floor({u(key)} * {len(items)})::BIGINT")
        return q(o or fallback)

    bnames = [b[0] for b in cfg.buckets]
    wanted = q(ov["length_bucket"]) if ov.get("length_bucket") else preset("length_bucket")
    drawn = _pick(bnames, weighted_index(u("length_bucket"), [b[3] for b in cfg.buckets]))
    blist = ", ".join(q(b) for b in bnames)
    bucket = f"CASE WHEN ({wanted}) IN ({blist}) THEN ({wanted}) ELSE {drawn} END"
    if ov.get("hashtags"):
        given = [ov["hashtags"]] if isinstance(ov["hashtags"], str) else ov["hashtags"]
        hashtags = clean_tags("[" + ", ".join(q(t) for t in given) + "]::VARCHAR[]")
    else:
        sets = ", ".join("[" + ", ".join(q(t) for t in s) + "]::VARCHAR[]" for s in cfg.hashtag_sets)
        hashtags = clean_tags(f"[{sets}][floor({u('hashtags')} * {len(cfg.hashtag_sets)})::BIGINT + 1]")
    style_id = _pick(names, si)
    prompt_id = q(ov["prompt_id"]) if ov.get("prompt_id") else f"printf('prompt-%s-%06d', {style_id}, id)"
    seed_col = str(int(ov["seed"])) if ov.get("seed") else \
        f"(1 + {hash48_sql('id', q('seed'), str(seed))} % {SEED_MAX})"

    def knob(k, cast):
        if k in ov:
            return f"CAST({_sql_lit(ov[k])} AS {cast})"
        return f"coalesce(CAST({preset(k)} AS {cast}), CAST({_sql_lit(KNOB_DEFAULTS[k])} AS {cast}))"

    return f"""SELECT id::BIGINT AS id, {prompt_id} AS prompt_id, {style_id} AS style_id,
    {choose(cfg.industries, 'industry', 'General')} AS industry, {choose(cfg.roles, 'role', 'Professional')} AS role,
    {q(ov.get('language', 'en'))} AS language, {bucket} AS length_bucket, {hashtags} AS hashtags,
    {seed_col}::BIGINT AS seed, {knob('cta_present', 'BOOLEAN')} AS cta_present,
    {knob('emoji_count', 'INTEGER')} AS emoji_count, {knob('cliche_count', 'INTEGER')} AS cliche_count,
    {knob('buzzword_count', 'INTEGER')} AS buzzword_count,
    {knob('has_explicit_humility_phrase', 'BOOLEAN')} AS has_explicit_humility_phrase,
    {knob('story_claims_verifiable', 'BOOLEAN')} AS story_claims_verifiable,
    {q(cfg.response_schema_version)} AS response_schema_version,
    {_sql_lit(ov.get('opening_hook_constraint'))}::VARCHAR AS opening_hook_constraint FROM ({ids_sql})"""


def json_string_array(e: str) -> str:
    """``json.dumps`` text of a list of strings: escapes, ``\\uXXXX`` beyond ASCII (surrogate pairs
    beyond the BMP), ``", "`` between the items."""
    u4 = "'\\u' || lower(lpad(to_hex({}), 4, '0'))"
    char = ("CASE WHEN c = '\"' THEN '\\\"' WHEN c = '\\' THEN '\\\\' WHEN ord(c) = 10 THEN '\\n' "
            "WHEN ord(c) = 13 THEN '\\r' WHEN ord(c) = 9 THEN '\\t' WHEN ord(c) = 8 THEN '\\b' "
            "WHEN ord(c) = 12 THEN '\\f' WHEN ord(c) BETWEEN 32 AND 126 THEN c "
            "WHEN ord(c) < 65536 THEN " + u4.format("ord(c)") + " ELSE "
            + u4.format("55296 + (ord(c) - 65536) // 1024") + " || " + u4.format("56320 + (ord(c) - 65536) % 1024") + " END")
    text = f"CASE WHEN x = '' THEN '' ELSE array_to_string(list_transform(string_split(x, ''), lambda c: {char}), '') END"
    return f"('[' || array_to_string(list_transform({e}, lambda x: '\"' || ({text}) || '\"'), ', ') || ']')"


def strip_ws(e: str) -> str:
    return f"regexp_replace({e}, {q('^' + tx.WHITESPACE_CLASS + '+|' + tx.WHITESPACE_CLASS + '+$')}, '', 'g')"
