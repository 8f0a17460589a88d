"""DuckDB SQL for the queries of the catalogue, over the same whole tables."""

from __future__ import annotations

import re

from phraseloom.functions import fixed_values as V
from phraseloom.operators.encode import DIM, MODULUS, MULTIPLIERS


def _clean(t: str) -> str:
    return rf"lower(trim(regexp_replace(coalesce({t}, ''), '\s+', ' ', 'g')))"


def _strip(t: str) -> str:
    return rf"regexp_replace({t}, '^\s+|\s+$', '', 'g')"


def _count_tokens(t: str) -> str:
    return rf"len(list_filter(string_split_regex({t}, '\s+'), lambda w: w <> ''))"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


LAB = """lab AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality AS label
  FROM documents d JOIN labels l USING (doc_id))"""

PAIRS = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS source_idiom, 'en' AS source_lang, a.text AS target_idiom,
         CASE u.conv_id % 3 WHEN 0 THEN 'hi' WHEN 1 THEN 'te' ELSE 'ml' END AS target_lang
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

UNIFIED = f"""{LAB}, {PAIRS}, everything AS (
  SELECT text AS source_idiom, lang AS source_lang, '' AS target_idiom, '' AS target_lang, label,
         '' AS idiom_string, 'train' AS split, source, 0 AS pri, doc_id AS o1, 0 AS o2 FROM lab
  UNION ALL
  SELECT source_idiom, source_lang, target_idiom, target_lang, -1, '', 'train', 'conversations', 1, conv_id, turn
  FROM pairs), unified AS (
  SELECT source_idiom, source_lang, target_idiom, target_lang, label, idiom_string, split, source FROM (
    SELECT *, row_number() OVER (PARTITION BY source_idiom, source_lang, label ORDER BY pri, o1, o2) AS rn
    FROM everything) WHERE rn = 1)"""

CLEANED = f"""{LAB}, all_cleaned AS (
  SELECT doc_id, {_clean("text")} AS text, label, '' AS idiom_string, source FROM lab), cleaned AS (
  SELECT text, label, idiom_string, source FROM (
    SELECT *, row_number() OVER (PARTITION BY text, label ORDER BY doc_id) AS rn
    FROM all_cleaned WHERE text <> '' AND {_count_tokens("text")} >= 3) WHERE rn = 1)"""


def _split(of: str, key: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f"""(SELECT *, CASE WHEN rn * 100 <= cnt * 70 THEN 'train' WHEN rn * 100 <= cnt * 85 THEN 'val'
                ELSE 'test' END AS split FROM (
      SELECT *, row_number() OVER ({part} ORDER BY md5('42:' || {key}), {key}) AS rn,
             count(*) OVER ({part}) AS cnt FROM {of}))"""


DICTIONARY = """dictionary AS (
  SELECT p_partkey, p_name AS native, p_type || ' ' || p_brand AS meaning FROM part), both_ways AS (
  SELECT native AS source_idiom, 'ml' AS source_lang, meaning AS target_idiom, 'en' AS target_lang, 1 AS label,
         native AS idiom_string, 'train' AS split, 'Kaggle-Indian-Idioms' AS source, p_partkey, 0 AS sub
  FROM dictionary
  UNION ALL
  SELECT meaning, 'en', native, 'ml', 1, native, 'train', 'Kaggle-Indian-Idioms-Reverse', p_partkey, 1
  FROM dictionary)"""

_S1 = "source_idiom, source_lang, target_idiom, target_lang, label, idiom_string, split, source"

_NAME = "CASE label WHEN 0 THEN 'Literal' WHEN 1 THEN 'Idiomatic' ELSE CAST(label AS VARCHAR) END"

IDX = """idx AS (
  SELECT vec_id AS row_id, 's' || vec_id AS source_idiom, 't' || vec_id AS target_idiom,
         CAST(label AS VARCHAR) AS target_lang, embedding, label FROM embeddings)"""

_DOT = "round(list_dot_product(q.embedding::DOUBLE[], i.embedding::DOUBLE[]), 10)"


def _hits(queries: str, rows: str, k: int, on: str) -> str:
    """Best k rows per query as CTE `hits`."""
    return f"""hits AS (
  SELECT query_id, CAST(rank AS INTEGER) AS rank, row_id, source_idiom, target_idiom, target_lang, round(s, 4) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, row_id) AS rank FROM (
      SELECT q.query_id, i.row_id, i.source_idiom, i.target_idiom, i.target_lang, {_DOT} AS s
      FROM {queries} q JOIN {rows} i ON {on})) WHERE rank <= {k})"""


_VEC_QUERIES = "(SELECT vec_id AS query_id, embedding, CAST(label AS VARCHAR) AS lang FROM embeddings)"

KNOWN = f"""{LAB}, known AS (
  SELECT doc_id AS query_id, text, embedding, l.label,
         CASE WHEN l.label = 1 THEN 0.75 ELSE 1.0 END::DOUBLE AS confidence
  FROM lab l JOIN embeddings e ON e.vec_id = l.doc_id)"""

TRANSLATED = f"""{KNOWN}, {IDX}, asked AS (
  SELECT *, CASE query_id % 4 WHEN 0 THEN 'hi' WHEN 1 THEN 'te' WHEN 2 THEN 'ml' END AS want,
         CASE query_id % 4 WHEN 0 THEN 'Hindi' WHEN 1 THEN 'Telugu' WHEN 2 THEN 'Malayalam' ELSE 'Tamil' END AS lang_name
  FROM known), idx3 AS (
  SELECT * REPLACE (CASE row_id % 3 WHEN 0 THEN 'hi' WHEN 1 THEN 'te' ELSE 'ml' END AS target_lang) FROM idx),
  {_hits(f"(SELECT * FROM asked WHERE label = 1 AND {_strip('text')} <> '')", "idx3", 5, "q.want IS NULL OR q.want = i.target_lang")},
  packed AS (
  SELECT query_id, string_agg('''' || target_idiom || '''', ', ' ORDER BY rank) AS list,
         max(CASE WHEN rank = 1 THEN target_idiom END) AS top FROM hits GROUP BY query_id), records AS (
  SELECT a.query_id, a.text AS english_idiom, a.confidence AS detected_confidence,
         CASE WHEN p.list IS NULL THEN '' ELSE {_text(V.CONTEXT_PREFIX)} || p.list END AS retrieved_context,
         a.lang_name AS target_language, coalesce(p.top, a.text) AS translation
  FROM asked a LEFT JOIN packed p USING (query_id) WHERE a.label = 1 AND {_strip('a.text')} <> '')"""

COUNTS = f"""{LAB}, scored AS (SELECT label AS actual, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS predicted FROM lab),
  four AS (
  SELECT count(*) FILTER (actual = 0 AND predicted = 0) AS c00, count(*) FILTER (actual = 0 AND predicted = 1) AS c01,
         count(*) FILTER (actual = 1 AND predicted = 0) AS c10, count(*) FILTER (actual = 1 AND predicted = 1) AS c11
  FROM scored), s AS (
  SELECT *, c00 / (c00 + c10) AS p0, c11 / (c11 + c01) AS p1, c00 / (c00 + c01) AS r0, c11 / (c11 + c10) AS r1,
         2 * c00 / (2 * c00 + c10 + c01) AS f0, 2 * c11 / (2 * c11 + c01 + c10) AS f1,
         (c00 + c11) / (c00 + c01 + c10 + c11) AS acc, c00 + c01 AS n0, c10 + c11 AS n1 FROM four)"""


def _buckets() -> str:
    """Length buckets as rows; the last one is open."""
    return ", ".join(f"({lo}, {'NULL' if hi is None else hi})" for lo, hi in zip(V.LENGTH_BOUNDS, [*V.LENGTH_BOUNDS[1:], None]))


def _histogram() -> str:
    rows = _buckets()
    return f"""WITH lens AS (SELECT {_count_tokens("text")} AS n FROM documents),
      b(lo, hi) AS (VALUES {rows})
      SELECT b.lo, b.hi, count(lens.n) AS n FROM b LEFT JOIN lens ON lens.n >= b.lo AND (b.hi IS NULL OR lens.n < b.hi) GROUP BY b.lo, b.hi"""


def _pair_expand() -> str:
    langs = [
        ("te", "p_name"),
        ("en", "CASE WHEN p_size % 3 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END"),
        ("hi", "p_brand"),
        ("ml", "p_type"),
    ]
    parts = [
        f"SELECT {a} AS source_idiom, '{la}' AS source_lang, {b} AS target_idiom, '{lb}' AS target_lang, 1 AS label, "
        f"{a} AS idiom_string, 'unlabeled' AS split, 'LIDIOMS' AS source, p_partkey AS entry FROM part"
        for i, (la, a) in enumerate(langs)
        for lb, b in langs[i + 1 :]
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE source_idiom <> '' AND target_idiom <> ''"


def _bleu_chain(t: str) -> str:
    out = rf"regexp_replace({t}, '\s+$', '')"
    for old, new in V.BLEU_LITERALS:
        old_sql = "'-' || chr(10)" if old == "-\n" else "chr(10)" if old == "\n" else _text(old)
        out = f"replace({out}, {old_sql}, {_text(new)})"
    out = f"' ' || {out} || ' '"
    for pattern, new in V.BLEU_PATTERNS:
        out = f"regexp_replace({out}, {_text(pattern)}, {_text(new.replace('$', chr(92)))}, 'g')"
    return rf"list_filter(string_split_regex({out}, '\s+'), lambda w: w <> '')"


def _bleu_parts(texts: str) -> str:
    """CTEs of counts and scores of `texts` (pair_id, prediction, reference); `w` and `l` hold one row each."""
    side = """SELECT pair_id, n, gram, count(*) AS c FROM (
      SELECT pair_id, unnest([1, 2, 3, 4]) AS n,
             unnest([w, w || ' ' || w2, w || ' ' || w2 || ' ' || w3, w || ' ' || w2 || ' ' || w3 || ' ' || w4]) AS gram
      FROM (SELECT pair_id, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4
            FROM (SELECT pair_id, unnest({c}) AS w, generate_subscripts({c}, 1) AS i FROM toks)
            WINDOW o AS (PARTITION BY pair_id ORDER BY i)))
      WHERE gram IS NOT NULL GROUP BY ALL"""
    return rf"""texts AS ({texts}),
    toks AS (SELECT pair_id, {_bleu_chain("prediction")} AS p, {_bleu_chain("reference")} AS r FROM texts),
    gp AS ({side.format(c="p")}), gr AS ({side.format(c="r")}),
    m AS (SELECT n, sum(least(gp.c, gr.c)) AS match FROM gp JOIN gr USING (pair_id, n, gram) GROUP BY n),
    t AS (SELECT n, sum(greatest(len(p) - n + 1, 0)) AS total FROM toks, (SELECT unnest([1, 2, 3, 4]) AS n) GROUP BY n),
    l AS (SELECT sum(len(p)) AS sys_len, sum(len(r)) AS ref_len FROM toks),
    w AS (SELECT {", ".join(f"max(CASE WHEN t.n = {n} THEN total END) AS total{n}, max(CASE WHEN t.n = {n} THEN coalesce(match, 0) END) AS match{n}" for n in range(1, 5))}
          FROM t LEFT JOIN m USING (n))"""


_BLEU_SCORE = """round(CASE WHEN sys_len < ref_len THEN exp(1 - ref_len / sys_len) ELSE 1 END
             * exp((ln(100 * match1 / total1) + ln(100 * match2 / total2) + ln(100 * match3 / total3) + ln(100 * match4 / total4)) / 4), 6)"""


def _bleu() -> str:
    texts = r"SELECT doc_id AS pair_id, text AS prediction, regexp_replace(text, '^\S+\s*', '') AS reference FROM documents"
    return f"""WITH {_bleu_parts(texts)}
    SELECT {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ["sys_len", "ref_len", *[f"total{n}" for n in range(1, 5)], *[f"match{n}" for n in range(1, 5)]])},
           {_BLEU_SCORE} AS bleu
    FROM w, l"""


def _prompt() -> str:
    system = _text(V.SYSTEM_TEXT.replace("{language}", "Hindi"))
    return f"""WITH {IDX}, {_hits(_VEC_QUERIES, "idx", 5, "i.target_lang = '3'")}, c AS (
      SELECT query_id, {_text(V.CONTEXT_PREFIX)} || string_agg('''' || target_idiom || '''', ', ' ORDER BY rank) AS context
      FROM hits GROUP BY query_id)
    SELECT query_id, context, {system} AS system_text,
      'English Idiom: ''s' || query_id || '''' || chr(10) || 'Figurative Meaning/Context: ' || context || chr(10)
      || 'Hindi Translation:' AS prompt FROM c"""


def _report() -> str:
    def row(table: str, metric: str, item: str, value: str, source: str, tail: str = "") -> str:
        return (
            f"SELECT '{table}' AS table_name, '{metric}' AS metric, CAST({item} AS VARCHAR) AS item, "
            f"CAST({value} AS VARCHAR) AS value FROM {source} {tail}"
        )

    cross = f"(SELECT * FROM unified WHERE {_strip('target_idiom')} <> '')"
    lens = f"(SELECT {_count_tokens('text')} AS n FROM cleaned)"
    rows = _buckets()
    sample = f"""(SELECT CASE WHEN label = 1 THEN 'Idiomatic' ELSE 'Literal' END AS a, substr({_strip("text")}, 1, 90) AS b
      FROM cleaned ORDER BY md5('42:' || text), 1, 2 LIMIT 5)"""
    parts = [
        row("unified", "n", "''", "count(*)", "unified"),
        row("detection", "n", "''", "count(*)", "cleaned"),
        row("cross_lingual", "n", "''", "count(*)", cross),
        row("unified", "source", "source", "count(*)", "unified", "GROUP BY source"),
        row("unified", "language", "source_lang", "count(*)", "unified", "GROUP BY source_lang"),
        row("detection", "class", _NAME, "count(*)", "cleaned", "GROUP BY label"),
        row("detection", "min_tokens", "''", "min(n)", lens),
        row("detection", "max_tokens", "''", "max(n)", lens),
        row("detection", "mean_tokens", "''", "round(avg(n), 1)", lens),
        row("detection", "median_tokens", "''", "CAST(median(n) AS DOUBLE)", lens),
        f"""SELECT 'detection', 'length_from', CAST(b.lo AS VARCHAR), CAST(count(l.n) AS VARCHAR)
            FROM (VALUES {rows}) b(lo, hi) LEFT JOIN {lens} l ON l.n >= b.lo AND (b.hi IS NULL OR l.n < b.hi) GROUP BY b.lo""",
        row("detection", "sample", "a", "b", sample),
        row("cross_lingual", "pair", "source_lang || ' → ' || target_lang", "count(*)", cross, "GROUP BY source_lang, target_lang"),
    ]
    for part in ("train", "val", "test"):
        source = f"(SELECT * FROM by_split WHERE split = '{part}')"
        part_lens = f"(SELECT {_count_tokens('text')} AS n FROM by_split WHERE split = '{part}')"
        parts += [
            row(part, "n", "''", "count(*)", source),
            row(part, "class", _NAME, "count(*)", source, "GROUP BY label"),
            row(part, "min_tokens", "''", "min(n)", part_lens),
            row(part, "max_tokens", "''", "max(n)", part_lens),
            row(part, "mean_tokens", "''", "round(avg(n), 1)", part_lens),
            row(part, "median_tokens", "''", "CAST(median(n) AS DOUBLE)", part_lens),
            f"""SELECT '{part}', 'length_from', CAST(b.lo AS VARCHAR), CAST(count(l.n) AS VARCHAR)
                FROM (VALUES {rows}) b(lo, hi) LEFT JOIN {part_lens} l ON l.n >= b.lo AND (b.hi IS NULL OR l.n < b.hi) GROUP BY b.lo""",
        ]
    both = ("train", "val"), ("train", "test"), ("val", "test")
    shared = {
        f"{a}_{b}": f"(SELECT count(*) FROM (SELECT text FROM by_split WHERE split = '{a}' INTERSECT SELECT text FROM by_split WHERE split = '{b}'))"
        for a, b in both
    }
    parts += [f"SELECT 'splits', '{name}', '', CAST({count} AS VARCHAR)" for name, count in shared.items()]
    parts.append(f"SELECT 'splits', 'clean', '', CAST({' + '.join(shared.values())} = 0 AS VARCHAR)")
    cleaned = CLEANED.split("all_cleaned AS", 1)[1]
    split = f"by_split AS (SELECT * FROM {_split('cleaned', 'text', 'label')})"
    return f"WITH {UNIFIED}, all_cleaned AS {cleaned}, {split} " + " UNION ALL ".join(f"({p})" for p in parts)


def _vectors(source: str, ident: str) -> str:
    """(ident, pos, x): the hashed 3-gram vector of each text as its non-zero elements."""
    a, b, c = MULTIPLIERS
    return f"""
      SELECT {ident}, pos, n / sqrt(sum(n * n) OVER (PARTITION BY {ident})) AS x FROM (
        SELECT {ident}, CAST((unicode(c0)::BIGINT * {a} + unicode(c1)::BIGINT * {b} + unicode(c2)::BIGINT * {c}) % {MODULUS} % {DIM} AS INTEGER) AS pos,
               CAST(count(*) AS DOUBLE) AS n
        FROM (SELECT {ident}, ch AS c0, lead(ch) OVER o AS c1, lead(ch, 2) OVER o AS c2
              FROM (SELECT {ident}, unnest(chars) AS ch, generate_subscripts(chars, 1) AS i
                    FROM (SELECT {ident}, string_split(' ' || lower({_strip('text')}) || ' ', '') AS chars
                          FROM {source} WHERE {_strip('text')} <> ''))
              WINDOW o AS (PARTITION BY {ident} ORDER BY i))
        WHERE c2 IS NOT NULL GROUP BY ALL)"""


def _token_f1_parts(texts: str) -> str:
    """CTEs up to `f` (pair_id, f1), greedy token F1 of `texts` (pair_id, prediction, reference)."""

    def toks(c: str) -> str:
        return rf"list_filter(string_split_regex({c}, '\s+'), lambda w: w <> '')"

    def side(name: str, c: str) -> str:
        return f"{name} AS (SELECT pair_id, unnest({c}) AS w, generate_subscripts({c}, 1) AS i FROM tk)"

    def best(name: str, by: str) -> str:
        return f"{name} AS (SELECT pair_id, avg(m) AS {name} FROM (SELECT pair_id, {by}, max(s) AS m FROM d GROUP BY pair_id, {by}) GROUP BY pair_id)"

    return f"""tk AS (SELECT pair_id, {toks('prediction')} AS pl, {toks('reference')} AS rl FROM ({texts})),
    {side('pw', 'pl')}, {side('rw', 'rl')},
    wd AS (SELECT w, w AS text FROM pw UNION SELECT w, w AS text FROM rw), v AS ({_vectors('wd', 'w')}),
    need AS (SELECT DISTINCT pw.w AS a, rw.w AS b FROM pw JOIN rw USING (pair_id)),
    dots AS (SELECT a, b, sum(x.x * y.x) AS s FROM need JOIN v x ON x.w = a JOIN v y ON y.w = b AND y.pos = x.pos GROUP BY a, b),
    d AS (SELECT pw.pair_id, pw.i, rw.i AS j, coalesce(s, 0) AS s FROM pw JOIN rw USING (pair_id) LEFT JOIN dots ON a = pw.w AND b = rw.w),
    {best('p', 'i')}, {best('r', 'j')},
    f AS (SELECT pair_id, coalesce(CASE WHEN p + r <> 0 THEN 2 * p * r / (p + r) ELSE 0 END, 0) AS f1
          FROM tk LEFT JOIN p USING (pair_id) LEFT JOIN r USING (pair_id))"""


def _text_f1() -> str:
    texts = "SELECT conv_id * 1000 + turn AS pair_id, target_idiom AS prediction, source_idiom AS reference FROM pairs"
    return f"WITH {PAIRS}, {_token_f1_parts(texts)} SELECT pair_id, round(f1, 4) AS f1 FROM f"


def _answered(asked: str) -> str:
    """CTEs up to `h` (id, context, top): the five nearest pairs of each row of `asked` (id, text, want)."""
    return f"""ixn AS (
      SELECT {_strip('source_idiom')} AS source_idiom, {_strip('target_idiom')} AS target_idiom, target_lang, conv_id, turn FROM pairs),
    ix AS (
      SELECT source_idiom, target_idiom, target_lang, min(conv_id * 1000 + turn) AS row_id FROM ixn
      WHERE source_idiom <> '' AND target_idiom <> '' GROUP BY ALL),
    ixt AS (SELECT row_id, source_idiom AS text FROM ix), asked AS ({asked}),
    iv AS ({_vectors('ixt', 'row_id')}), qv AS ({_vectors('asked', 'id')}),
    near AS (SELECT id, row_id, round(sum(CAST(iv.x AS FLOAT)::DOUBLE * CAST(qv.x AS FLOAT)::DOUBLE), 10) AS s
             FROM qv JOIN iv USING (pos) GROUP BY id, row_id),
    every AS (SELECT a.id, ix.row_id, ix.target_idiom, coalesce(near.s, 0) AS s
              FROM (SELECT DISTINCT id FROM qv) v JOIN asked a USING (id) JOIN ix ON ix.target_lang = a.want
              LEFT JOIN near ON near.id = a.id AND near.row_id = ix.row_id WHERE ix.row_id IN (SELECT row_id FROM iv)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, row_id) AS rank FROM every),
    h AS (SELECT id, {_text(V.CONTEXT_PREFIX)} || string_agg('''' || target_idiom || '''', ', ' ORDER BY rank) AS context,
                 max(CASE WHEN rank = 1 THEN target_idiom END) AS top FROM ranked WHERE rank <= 5 GROUP BY id)"""


def _given_score() -> str:
    """CTEs up to `given` (doc_id, text, score) of the model of given coefficients."""
    from phraseloom.catalog import GIVEN

    table = "[" + ", ".join(f"{c!r}::DOUBLE" for c in GIVEN.coefficients) + "]"
    place = f"(unicode(w) * 31 + unicode(right(w, 1)) * 17 + length(w)) % {len(GIVEN.coefficients)} + 1"
    return rf"""ww AS (SELECT doc_id, text, list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda w: w <> '') AS l FROM documents),
    wt AS (SELECT doc_id, text, len(l) AS n, {table} AS c, l FROM ww),
    given AS (SELECT doc_id, text, {GIVEN.intercept!r}::DOUBLE + coalesce(list_sum(list_transform(l, lambda w: c[{place}])), 0) / greatest(n, 1) AS score FROM wt)"""


_CONFIDENCE = "round(CASE WHEN score > 0 THEN 1 / (1 + exp(-score)) ELSE 1 / (1 + exp(score)) END, 4)"


def _translate_text() -> str:
    asked = f"SELECT doc_id AS id, text, score, 'hi' AS want FROM given WHERE score > 0 AND {_strip('text')} <> ''"
    return f"""WITH {PAIRS}, {_given_score()}, {_answered(asked)}
    SELECT a.id AS query_id, a.text AS english_idiom, {_CONFIDENCE} AS detected_confidence, coalesce(h.context, '') AS retrieved_context,
           'Hindi' AS target_language, coalesce(h.top, a.text) AS translation
    FROM asked a LEFT JOIN h USING (id)"""


def _translation_report() -> str:
    te = "te AS (SELECT conv_id * 1000 + turn AS id, source_idiom AS text, target_idiom AS reference FROM pairs WHERE target_lang = 'te')"
    asked = f"SELECT id, text, 'te' AS want FROM te WHERE length(text) % 2 = 1 AND {_strip('text')} <> ''"
    said = "SELECT te.id AS pair_id, CASE WHEN a.id IS NULL THEN te.text ELSE coalesce(h.top, te.text) END AS prediction, reference FROM te LEFT JOIN asked a ON a.id = te.id LEFT JOIN h ON h.id = te.id"
    return f"""WITH {PAIRS}, {te}, {_answered(asked)}, said AS ({said}),
    {_bleu_parts("SELECT * FROM said")}, {_token_f1_parts("SELECT * FROM said")},
    e AS (SELECT count(*) AS pairs, count(*) FILTER ({_strip('prediction')} = {_strip('reference')}) AS exact_matches FROM said)
    SELECT 'telugu' AS language, pairs, exact_matches, exact_matches / pairs * 100 AS exact_match_pct, {_BLEU_SCORE} AS bleu,
           (SELECT round(avg(f1), 6) FROM f) AS token_f1, CAST(0 AS BIGINT) AS failures FROM e, w, l"""


def _stream() -> str:
    return f"""WITH {PAIRS}, n AS (
      SELECT {_strip('source_idiom')} AS source_idiom, {_strip('target_idiom')} AS target_idiom, target_lang, conv_id, turn
      FROM pairs), d AS (
      SELECT source_idiom, target_idiom, target_lang, min(conv_id * 1000 + turn) AS row_id FROM n
      WHERE source_idiom <> '' AND target_idiom <> '' GROUP BY ALL),
      t AS (SELECT row_id, source_idiom AS text FROM d),
      asked AS (SELECT item_id, text, CASE item_id % 4 WHEN 0 THEN 'hi' WHEN 1 THEN 'te' ELSE 'ml' END AS want FROM benchmark),
      odd AS (SELECT * FROM asked WHERE length(text) % 2 = 1 AND {_strip('text')} <> ''),
      iv AS ({_vectors('t', 'row_id')}), qv AS ({_vectors('odd', 'item_id')}),
      s AS (SELECT item_id, row_id, round(sum(CAST(iv.x AS FLOAT)::DOUBLE * CAST(qv.x AS FLOAT)::DOUBLE), 10) AS s
            FROM qv JOIN iv USING (pos) GROUP BY item_id, row_id),
      r AS (SELECT item_id, target_idiom, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, row_id) AS rank
            FROM s JOIN d USING (row_id) JOIN odd USING (item_id) WHERE d.target_lang = odd.want),
      h AS (SELECT item_id, {_text(V.CONTEXT_PREFIX)} || string_agg('''' || target_idiom || '''', ', ' ORDER BY rank) AS context,
                   max(CASE WHEN rank = 1 THEN target_idiom END) AS top FROM r WHERE rank <= 5 GROUP BY item_id)
      SELECT CAST(a.item_id AS VARCHAR) AS request_id,
        CASE WHEN a.text = '' THEN NULL WHEN odd.item_id IS NULL THEN {_text(V.RESPONSE_LITERAL_CONTEXT)} ELSE coalesce(h.context, '') END AS retrieved_context,
        CASE WHEN a.text = '' THEN NULL WHEN odd.item_id IS NULL THEN {_text(V.RESPONSE_LITERAL_TRANSLATION)} ELSE coalesce(h.top, a.text) END AS generated_translation,
        CASE WHEN a.text = '' THEN {_text(V.RESPONSE_NO_TEXT)} END AS error
      FROM asked a LEFT JOIN odd USING (item_id) LEFT JOIN h USING (item_id)"""


def _room(template: str) -> int:
    """Characters of a template beside its {places}."""
    return len(re.sub(r"\{\w+\}", "", template))


def oracle_sql() -> dict[str, str]:
    name = _NAME
    by_split = _split("cleaned", "text", "label")
    return {
        "clean_text": f"SELECT doc_id, {_clean('text')} AS text, {_count_tokens('text')} AS n FROM documents",
        "labelled_sentences": f"""WITH {LAB} SELECT text AS source_idiom, 'en' AS source_lang, '' AS target_idiom,
            '' AS target_lang, CASE WHEN label = 1 THEN 1 ELSE 0 END AS label, source AS idiom_string, lang AS split,
            'MAGPIE' AS source FROM lab""",
        "tagged_tokens": """SELECT text AS source_idiom, 'en' AS source_lang, '' AS target_idiom, '' AS target_lang,
            CASE WHEN len(list_filter(string_split(text, ' '), lambda w: length(w) > 24)) > 0 THEN 1 ELSE 0 END AS label,
            source AS idiom_string, lang AS split, 'PIE-English' AS source FROM documents""",
        "pair_expand": _pair_expand(),
        "parallel_corpus": f"""WITH {PAIRS}, p AS (
            SELECT *, row_number() OVER (ORDER BY conv_id * 1000 + turn) - 1 AS pos, count(*) OVER () AS total FROM pairs),
            s AS (SELECT *, greatest(1, total // least(100, total)) AS step FROM p)
            SELECT {_strip('source_idiom')} AS source_idiom, 'en' AS source_lang, {_strip('target_idiom')} AS target_idiom,
            'hi' AS target_lang, -1 AS label, '' AS idiom_string, 'train' AS split, 'Kunchukuttan' AS source
            FROM s WHERE pos % step = 0 AND pos // step < 100
            AND {_strip('source_idiom')} <> '' AND {_strip('target_idiom')} <> ''""",
        "bidirectional_pairs": f"WITH {DICTIONARY} SELECT {_S1} FROM both_ways",
        "unify_dedup": f"WITH {UNIFIED} SELECT * FROM unified",
        "detection_subset": f"WITH {UNIFIED} SELECT * FROM unified WHERE label IN (0, 1)",
        "cross_lingual_subset": f"WITH {UNIFIED} SELECT * FROM unified WHERE {_strip('target_idiom')} <> ''",
        "min_tokens": f"""WITH {LAB}, c AS (SELECT doc_id, {_clean('text')} AS text, label FROM lab)
            SELECT * FROM c WHERE text <> '' AND {_count_tokens('text')} >= 3""",
        "dedup_clean": f"WITH {CLEANED} SELECT * FROM cleaned",
        "dropped_counts": f"""WITH {CLEANED} SELECT count(*) AS rows_in, count(*) FILTER (text = '') AS blank_dropped,
            count(*) FILTER (text <> '' AND {_count_tokens('text')} < 3) AS short_dropped,
            count(*) FILTER (text <> '' AND {_count_tokens('text')} >= 3) - (SELECT count(*) FROM cleaned) AS duplicates_removed,
            (SELECT count(*) FROM cleaned) AS rows_kept FROM all_cleaned""",
        "blank_rejected": f"""WITH {LAB} SELECT doc_id, {_text(V.MESSAGE_BLANK)} AS error FROM lab
            WHERE n_chars % 4 = 0 OR {_strip('text')} = ''""",
        "index_pairs": f"""WITH {PAIRS}, {DICTIONARY}, u AS (
            SELECT source_idiom, source_lang, target_idiom, target_lang, 'conversations' AS source, 0 AS pri, conv_id AS o1, turn AS o2 FROM pairs
            UNION ALL SELECT source_idiom, source_lang, target_idiom, target_lang, source, 1, p_partkey, sub FROM both_ways),
            n AS (SELECT {_strip('source_idiom')} AS source_idiom, source_lang, {_strip('target_idiom')} AS target_idiom,
                  target_lang, source, pri, o1, o2 FROM u)
            SELECT source_idiom, source_lang, target_idiom, target_lang, source FROM (
              SELECT *, row_number() OVER (PARTITION BY source_idiom, source_lang, target_idiom, target_lang ORDER BY pri, o1, o2) AS rn
              FROM n WHERE source_idiom <> '' AND target_idiom <> '') WHERE rn = 1""",
        "index_row_ids": f"""WITH {DICTIONARY}, f AS (
            SELECT *, row_number() OVER (PARTITION BY source_idiom, source_lang, target_idiom, target_lang ORDER BY p_partkey, sub) AS rn
            FROM both_ways)
            SELECT row_number() OVER (ORDER BY p_partkey, sub) - 1 AS row_id, source_idiom, source_lang, target_idiom, target_lang
            FROM f WHERE rn = 1""",
        "exclude_source": f"""WITH {UNIFIED} SELECT source_idiom, source_lang, label, source FROM unified WHERE source <> 'src1'""",
        "language_filter": f"WITH {PAIRS} SELECT * FROM pairs WHERE source_lang = 'en' AND target_lang = 'te'",
        "index_manifest": f"""WITH {IDX} SELECT 'driver vectors' AS model_name, count(*) AS rows_indexed,
            CAST(max(len(embedding)) AS INTEGER) AS embedding_dim, 'en' AS source_langs,
            string_agg(DISTINCT target_lang, ',' ORDER BY target_lang) AS target_langs FROM idx""",
        "distinct_languages": f"""WITH {UNIFIED} SELECT string_agg(DISTINCT source_lang, ',' ORDER BY source_lang) AS source_langs,
            string_agg(DISTINCT target_lang, ',' ORDER BY target_lang) AS target_langs FROM unified""",
        "row_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ("documents", "labels", "conversations", "embeddings")
        ),
        "label_distribution": f"""WITH {UNIFIED} SELECT {name} AS label_name, count(*) AS n FROM unified
            WHERE label IN (0, 1) GROUP BY label""",
        "class_balance": f"""WITH {LAB} SELECT {name} AS label_name, count(*) AS n,
            round(100 * (count(*) / sum(count(*)) OVER ()), 1) AS pct,
            repeat('█', CAST(floor(30 * (count(*) / sum(count(*)) OVER ())) AS INTEGER)) AS bar FROM lab GROUP BY label""",
        "imbalance": f"""WITH {CLEANED}, c AS (SELECT count(*) AS n FROM cleaned GROUP BY label)
            SELECT min(n) AS minority, max(n) AS majority, min(n) / max(n) AS ratio, min(n) / max(n) < 0.4 AS imbalanced FROM c""",
        "distinct_label_count": f"WITH {LAB} SELECT count(DISTINCT label) AS n_labels FROM lab",
        "length_stats": f"""WITH l AS (SELECT {_count_tokens('text')} AS n FROM documents)
            SELECT min(n) AS min_tokens, max(n) AS max_tokens, round(avg(n), 1) AS mean_tokens,
            CAST(median(n) AS DOUBLE) AS median_tokens FROM l""",
        "length_histogram": _histogram(),
        "source_breakdown": "SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source",
        "language_counts": f"WITH {UNIFIED} SELECT source_lang, count(*) AS n FROM unified GROUP BY source_lang",
        "pair_coverage": f"""WITH {PAIRS} SELECT source_lang || ' → ' || target_lang AS pair, count(*) AS n
            FROM pairs GROUP BY 1 ORDER BY n DESC, pair LIMIT 15""",
        "systematic_sample": """WITH p AS (SELECT doc_id, lang, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS pos,
            count(*) OVER () AS total FROM documents), s AS (SELECT *, greatest(1, total // least(300, total)) AS step FROM p)
            SELECT doc_id, lang, n_chars FROM s WHERE pos % step = 0 AND pos // step < 300""",
        "stratified_split": f"WITH {CLEANED} SELECT text, label, split FROM {by_split}",
        "random_split": f"SELECT doc_id, split FROM {_split('documents', 'doc_id')}",
        "split_stats": f"""WITH {CLEANED} SELECT split, {name} AS label_name, count(*) AS n,
            round(100 * count(*) / sum(count(*)) OVER (PARTITION BY split), 1) AS pct FROM {by_split} GROUP BY split, label""",
        "leakage": f"""WITH {LAB}, s AS (SELECT DISTINCT text, split FROM {_split('lab', 'doc_id', 'label')}), o AS (
            SELECT (SELECT count(*) FROM (SELECT text FROM s WHERE split = 'train' INTERSECT SELECT text FROM s WHERE split = 'val')) AS train_val,
                   (SELECT count(*) FROM (SELECT text FROM s WHERE split = 'train' INTERSECT SELECT text FROM s WHERE split = 'test')) AS train_test,
                   (SELECT count(*) FROM (SELECT text FROM s WHERE split = 'val' INTERSECT SELECT text FROM s WHERE split = 'test')) AS val_test)
            SELECT *, train_val + train_test + val_test = 0 AS clean FROM o""",
        "sample_rows": f"""WITH {LAB}, r AS (SELECT CASE WHEN label = 1 THEN 'Idiomatic' ELSE 'Literal' END AS label_name,
            substr({_strip('text')}, 1, 90) AS sample_text, md5('42:' || text) AS h FROM lab)
            SELECT label_name, sample_text FROM r ORDER BY h, label_name, sample_text LIMIT 5""",
        "head_per_language": """SELECT doc_id, lang FROM (
            SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 50""",
        "profile_report": _report(),
        "l2_normalize": """WITH s AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x * CAST(vec_id + 1 AS FLOAT) AS FLOAT)) AS e FROM embeddings),
            n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x::DOUBLE * x::DOUBLE))) AS norm FROM s),
            u AS (SELECT vec_id, norm, unnest(e) AS x, unnest(generate_series(0, len(e) - 1)) AS pos FROM n)
            SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(CAST(x::DOUBLE / norm AS FLOAT)::DOUBLE, 5) AS x FROM u""",
        "retrieve_topk": f"""WITH {IDX}, {_hits(_VEC_QUERIES, "idx", 5, "true")}
            SELECT query_id, rank, row_id, source_idiom, target_idiom, target_lang, score FROM hits""",
        "retrieve_topk_filtered": f"""WITH {IDX}, {_hits(_VEC_QUERIES, "idx", 5, "i.target_lang = '3'")}
            SELECT query_id, rank, row_id, target_lang, score FROM hits""",
        "retrieve_topk_own_language": f"""WITH {IDX}, {_hits(_VEC_QUERIES, "idx", 5, "i.target_lang = q.lang")}
            SELECT query_id, rank, row_id, target_lang, score FROM hits""",
        "retrieve_topk_blocks": f"""WITH {IDX}, {_hits(_VEC_QUERIES, "idx", 5, "true")}
            SELECT query_id, rank, row_id, target_lang, score FROM hits""",
        "retrieve_topk_few_queries": f"""WITH {IDX}, {_hits(_VEC_QUERIES, "idx", 5, "true")}
            SELECT query_id, rank, row_id, target_lang, score FROM hits""",
        "meaning_pairs": f"""WITH {DICTIONARY} SELECT {_strip('meaning')} AS source_idiom, 'en' AS source_lang,
            {_strip('native')} AS target_idiom, CASE p_partkey % 3 WHEN 0 THEN 'hi' ELSE 'te' END AS target_lang,
            CASE p_partkey % 3 WHEN 0 THEN 'Raw-hindi.json' ELSE 'Raw-telugu.json' END AS source
            FROM dictionary WHERE p_partkey % 3 < 2""",
        "translate_stream": _stream(),
        "encode_text": f"""SELECT doc_id, pos, round(CAST(CAST(x AS FLOAT) AS DOUBLE), 4) AS x
            FROM ({_vectors('documents', 'doc_id')})""",
        "retrieve_text": f"""WITH {PAIRS}, n AS (
            SELECT {_strip('source_idiom')} AS source_idiom, {_strip('target_idiom')} AS target_idiom, conv_id, turn
            FROM pairs WHERE target_lang = 'hi'), d AS (
            SELECT source_idiom, target_idiom, min(conv_id * 1000 + turn) AS row_id FROM n
            WHERE source_idiom <> '' AND target_idiom <> '' GROUP BY ALL),
            t AS (SELECT row_id, source_idiom AS text FROM d),
            iv AS ({_vectors('t', 'row_id')}), qv AS ({_vectors('benchmark', 'item_id')}),
            s AS (SELECT item_id, row_id, round(sum(CAST(iv.x AS FLOAT)::DOUBLE * CAST(qv.x AS FLOAT)::DOUBLE), 10) AS s
                  FROM qv JOIN iv USING (pos) GROUP BY item_id, row_id),
            r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, row_id) AS rank FROM s)
            SELECT item_id AS query_id, CAST(rank AS INTEGER) AS rank, source_idiom, target_idiom, round(s, 4) AS score
            FROM r JOIN d USING (row_id) WHERE rank <= 5""",
        "gate_retrieve": f"""WITH {KNOWN}, {IDX}, {_hits("(SELECT * FROM known WHERE label = 1)", "idx", 3, "true")}
            SELECT k.query_id, any_value({name.replace('label', 'k.label')}) AS label, any_value(k.confidence) AS confidence,
            coalesce(string_agg(h.target_idiom, ',' ORDER BY h.rank), '') AS found,
            any_value(CASE WHEN k.label = 0 THEN {_text(V.MESSAGE_LITERAL)} END) AS message
            FROM known k LEFT JOIN hits h USING (query_id) GROUP BY k.query_id""",
        "gate_without_detector": f"""WITH {KNOWN}, {IDX}, {_hits("known", "idx", 3, "true")}
            SELECT query_id, 'Unavailable' AS label, string_agg(target_idiom, ',' ORDER BY rank) AS found,
            {_text(V.MESSAGE_NO_DETECTOR.format(detail="model folder not found"))} AS message FROM hits GROUP BY query_id""",
        "gate_scoring_failure": f"""WITH {KNOWN}, {IDX}, tried AS (
              SELECT query_id, text, embedding, length(text) % 5 = 0 AS failed, length(text) % 2 = 1 AS odd FROM known),
            {_hits("(SELECT * FROM tried WHERE failed OR odd)", "idx", 3, "true")}
            SELECT t.query_id, any_value(CASE WHEN failed THEN 'Unavailable' WHEN odd THEN 'Idiomatic' ELSE 'Literal' END) AS label,
            any_value(CASE WHEN NOT failed THEN round(exp(2) / (exp(2) + 1), 4) END) AS confidence,
            coalesce(string_agg(h.target_idiom, ',' ORDER BY h.rank), '') AS found,
            any_value(CASE WHEN failed THEN {_text(V.MESSAGE_NO_DETECTOR.format(detail="no score for a text of this length"))}
              WHEN NOT odd THEN {_text(V.MESSAGE_LITERAL)} END) AS message
            FROM tried t LEFT JOIN hits h USING (query_id) GROUP BY t.query_id""",
        "predict_given_model": f"""WITH {_given_score()} SELECT doc_id, CASE WHEN score > 0 THEN 'Idiomatic' ELSE 'Literal' END AS label,
            {_CONFIDENCE} AS confidence, CASE WHEN score > 0 THEN 1 ELSE 0 END AS predicted FROM given""",
        "translate_text": _translate_text(),
        "translation_report": _translation_report(),
        "read_or_fallback": f"""WITH {LAB}, blank AS (SELECT *, CASE WHEN length(text) % 2 = 0 THEN '' END AS none FROM lab)
            SELECT text AS source_idiom, 'en' AS source_lang, none AS target_idiom, none AS target_lang,
            CAST(label AS INTEGER) AS label, source AS idiom_string, 'train' AS split, 'MAGPIE' AS source FROM blank""",
        "unify_job": f"""WITH {LAB}, {PAIRS}, {DICTIONARY}, everything AS (
            SELECT text AS source_idiom, 'en' AS source_lang, '' AS target_idiom, CAST(label AS INTEGER) AS label, 'MAGPIE' AS source, 0 AS pri FROM lab
            UNION ALL SELECT source_idiom, source_lang, target_idiom, label, source, 1 FROM ({_pair_expand()})
            UNION ALL SELECT {_strip('source_idiom')}, 'en', {_strip('target_idiom')}, -1, 'Kunchukuttan', 2 FROM pairs
              WHERE {_strip('source_idiom')} <> '' AND {_strip('target_idiom')} <> ''
            UNION ALL SELECT source_idiom, source_lang, target_idiom, label, source, 3 + sub FROM both_ways),
            first AS (SELECT source_idiom, source_lang, label, min(pri) AS pri FROM everything GROUP BY ALL),
            kept AS (SELECT source_idiom, source_lang, label, CASE pri WHEN 0 THEN 'MAGPIE' WHEN 1 THEN 'LIDIOMS' WHEN 2 THEN 'Kunchukuttan'
                     WHEN 3 THEN 'Kaggle-Indian-Idioms' ELSE 'Kaggle-Indian-Idioms-Reverse' END AS source, pri FROM first)
            SELECT source, label, count(*) AS n, count(DISTINCT source_idiom) AS n_texts,
                   CASE WHEN any_value(pri) = 0 THEN 0 ELSE count(*) END AS n_cross FROM kept GROUP BY source, label""",
        "prepare_job": f"WITH {CLEANED} SELECT text, label, split FROM {by_split}",
        "index_job": f"""WITH {PAIRS}, n AS (
            SELECT {_strip('source_idiom')} AS source_idiom, {_strip('target_idiom')} AS target_idiom, target_lang, conv_id, turn FROM pairs
            WHERE target_lang = 'te'), f AS (
            SELECT source_idiom, target_idiom, target_lang, min(conv_id * 1000 + turn) AS place FROM n
            WHERE source_idiom <> '' AND target_idiom <> '' GROUP BY ALL)
            SELECT row_number() OVER (ORDER BY place) - 1 AS row_id, source_idiom, target_idiom, target_lang, CAST({DIM} AS INTEGER) AS dim FROM f""",
        "translator_hook": f"""WITH {TRANSLATED} SELECT a.query_id, r.query_id IS NOT NULL AS translated,
            CASE WHEN r.query_id IS NOT NULL THEN CAST({_room(V.SYSTEM_TEXT)} + {V.SYSTEM_TEXT.count("{")} * length(a.lang_name) AS VARCHAR) || ':' ||
              CAST({_room(V.PROMPT_IDIOM_LINE)} + length(a.text) + {_room(V.PROMPT_LAST_LINE)} + length(a.lang_name)
                + CASE WHEN r.retrieved_context <> '' THEN {_room(V.PROMPT_CONTEXT_LINE)} + length(r.retrieved_context) ELSE 0 END AS VARCHAR) END AS translation
            FROM asked a LEFT JOIN records r USING (query_id)""",
        "csv_by_header": f"""WITH {PAIRS}, p AS (SELECT *, length(source_idiom) % 3 < 2 AS full_header FROM pairs)
            SELECT source_idiom, source_lang, target_idiom, target_lang, CASE WHEN full_header THEN -1 END AS label,
            CAST(NULL AS VARCHAR) AS idiom_string, CASE WHEN full_header THEN 'train' END AS split,
            CASE WHEN full_header THEN 'conversations' END AS source FROM p""",
        "confusion": f"""WITH {COUNTS} SELECT 'Literal' AS actual, c00 AS literal, c01 AS idiomatic FROM four
            UNION ALL SELECT 'Idiomatic', c10, c11 FROM four""",
        "class_report": f"""WITH {COUNTS}
            SELECT 'Literal' AS row_name, round(p0, 4) AS "precision", round(r0, 4) AS recall, round(f0, 4) AS f1, n0 AS support FROM s
            UNION ALL SELECT 'Idiomatic', round(p1, 4), round(r1, 4), round(f1, 4), n1 FROM s
            UNION ALL SELECT 'accuracy', round(acc, 4), round(acc, 4), round(acc, 4), n0 + n1 FROM s
            UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 4), round((r0 + r1) / 2, 4), round((f0 + f1) / 2, 4), n0 + n1 FROM s
            UNION ALL SELECT 'weighted avg', round((p0 * n0 + p1 * n1) / (n0 + n1), 4), round((r0 * n0 + r1 * n1) / (n0 + n1), 4),
              round((f0 * n0 + f1 * n1) / (n0 + n1), 4), n0 + n1 FROM s""",
        "macro_metrics": f"""WITH {COUNTS} SELECT round(acc, 9) AS accuracy, round((f0 + f1) / 2, 9) AS f1,
            round((p0 + p1) / 2, 9) AS "precision", round((r0 + r1) / 2, 9) AS recall FROM s""",
        "softmax_argmax": """WITH x AS (SELECT vec_id, embedding[1]::DOUBLE * 10 AS a, embedding[2]::DOUBLE * 10 AS b FROM embeddings)
            SELECT vec_id, round(exp(a - greatest(a, b)) / (exp(a - greatest(a, b)) + exp(b - greatest(a, b))), 6) AS p0,
            round(exp(b - greatest(a, b)) / (exp(a - greatest(a, b)) + exp(b - greatest(a, b))), 6) AS p1,
            CASE WHEN b > a THEN 1 ELSE 0 END AS class_id, CASE WHEN b > a THEN 'Idiomatic' ELSE 'Literal' END AS label FROM x""",
        "language_names": f"""WITH {KNOWN} SELECT query_id,
            CASE query_id % 4 WHEN 0 THEN 'hi' WHEN 1 THEN 'te' WHEN 2 THEN 'ml' END AS code,
            CASE query_id % 4 WHEN 0 THEN 'hindi' WHEN 1 THEN 'telugu' ELSE 'malayalam' END AS name FROM known""",
        "context_prompt": _prompt(),
        "translate_batch": f"WITH {TRANSLATED} SELECT * FROM records",
        "api_response": f"""WITH {TRANSLATED} SELECT a.query_id,
            CASE WHEN a.query_id % 7 = 0 OR a.text = '' THEN NULL WHEN r.query_id IS NULL THEN {_text(V.RESPONSE_LITERAL_CONTEXT)}
              ELSE r.retrieved_context END AS retrieved_context,
            CASE WHEN a.query_id % 7 = 0 OR a.text = '' THEN NULL WHEN r.query_id IS NULL THEN {_text(V.RESPONSE_LITERAL_TRANSLATION)}
              ELSE r.translation END AS generated_translation,
            CASE WHEN a.query_id % 7 = 0 OR a.text = '' THEN {_text(V.RESPONSE_NO_TEXT)} END AS error
            FROM asked a LEFT JOIN records r USING (query_id)""",
        "literal_passthrough": f"""WITH {TRANSLATED} SELECT a.query_id, a.text, coalesce(r.translation, a.text) AS prediction
            FROM asked a LEFT JOIN records r USING (query_id)""",
        "exact_match": rf"""WITH t AS (SELECT text AS p, CASE WHEN doc_id % 3 = 0 THEN ' ' || text
            ELSE regexp_replace(text, '^\S+\s*', '') END AS r FROM documents), m AS (
            SELECT count(*) AS pairs, count(*) FILTER ({_strip('p')} = {_strip('r')}) AS exact_matches FROM t)
            SELECT pairs, exact_matches, exact_matches / pairs * 100 AS exact_match_pct FROM m""",
        "corpus_bleu": _bleu(),
        "text_token_f1": _text_f1(),
        "greedy_token_f1": """WITH e AS (SELECT vec_id, vec_id // 5 AS g, embedding::DOUBLE[] AS v FROM embeddings),
            d AS (SELECT a.g, a.vec_id AS a, b.vec_id AS b, list_dot_product(a.v, b.v) AS s FROM e a JOIN e b ON b.g = a.g + 1),
            p AS (SELECT g, avg(m) AS p FROM (SELECT g, a, max(s) AS m FROM d GROUP BY g, a) GROUP BY g),
            r AS (SELECT g, avg(m) AS r FROM (SELECT g, b, max(s) AS m FROM d GROUP BY g, b) GROUP BY g)
            SELECT round(avg(2 * p * r / (p + r)), 6) AS token_f1 FROM p JOIN r USING (g)""",
    }
