"""DuckDB SQL for the queries that SQL can express over whole tables.

Written from the contracts and the operators' definitions, in another way than
the operators work: windows and positions are unnested and grouped, exponents
are tried one by one, permutations are sorted in one go. The other queries
(HTML labelling, licence scan, SimHash, packing, sharding and the pipeline) are
compared with brute force in the tests.
"""

from __future__ import annotations

from ledgerline.llm import chat, collocations, line_quality, mixing, queries

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = r"[\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"


# ------------------------------------------------------------------- mixing
MIXING = f"""
WITH rows AS (
  SELECT doc_id, source, COALESCE(md5(text), 'null') AS text_hash, COALESCE(len({_words('text')}), 0) AS tokens FROM documents
), units AS (
  SELECT doc_id, source, text_hash, COUNT(*) AS copies, CAST(SUM(tokens) AS BIGINT) AS tokens FROM rows GROUP BY ALL
), totals AS (
  SELECT source, CAST(SUM(tokens) AS BIGINT) AS total FROM units GROUP BY source
), live AS (
  SELECT total, total / (SELECT SUM(total) FROM totals) AS p FROM totals WHERE total > 0
), tried AS (
  SELECT step, ln(SUM(pow(p, step / {mixing.GRID}.0))) - step / {mixing.GRID}.0 * SUM(pow(p, step / {mixing.GRID}.0) * ln(p))
    / SUM(pow(p, step / {mixing.GRID}.0)) AS entropy,
    pow(MAX(p) / MIN(p), 1 - step / {mixing.GRID}.0) AS repeats, COUNT(*) AS sources
  FROM live, range({mixing.GRID} + 1) g(step) GROUP BY step
), solved AS (
  SELECT CASE WHEN COALESCE(MAX(sources), 0) < 2 THEN 1.0 ELSE greatest(
    COALESCE(MAX(step) FILTER (WHERE entropy >= {mixing.TARGET_ENTROPY} * ln(sources) - {mixing.SLACK}), 0),
    COALESCE(MIN(step) FILTER (WHERE repeats <= {mixing.MAX_REPEATS} + {mixing.SLACK}), {mixing.GRID})) / {mixing.GRID}.0 END AS a
  FROM tried
), scale AS (
  SELECT a, SUM(pow(total, a)) AS power, MAX(pow(total, 1 - a)) * SUM(pow(total, a)) AS whole FROM live, solved GROUP BY a
), budgets AS (
  SELECT source, total, CASE WHEN total > 0
    THEN CAST(floor(round(pow(total, a) / power * whole, 3) + 0.0005) AS BIGINT) ELSE 0 END AS budget
  FROM totals LEFT JOIN scale ON true
), laid AS (
  SELECT u.*, b.total, b.budget, unnest(range(CASE WHEN b.total > 0 THEN CAST(ceil(b.budget / b.total) AS BIGINT) ELSE 1 END)) AS block
  FROM units u JOIN budgets b ON u.source IS NOT DISTINCT FROM b.source
), placed AS (
  SELECT *, COALESCE(SUM(copies) OVER w, 0) AS position, COALESCE(SUM(tokens) OVER w, 0) AS before FROM laid
  WINDOW w AS (PARTITION BY source, block ORDER BY md5(concat('29/', block, '/', COALESCE(CAST(doc_id AS VARCHAR), 'null'), '/', text_hash))
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT doc_id, source, copies, tokens, CAST(block AS INTEGER) AS block, CAST(position AS BIGINT) AS position FROM placed
WHERE total = 0 OR block * total + before < budget OR (block + 1) * total <= budget"""

# --------------------------------------------------------- decontamination
_ITEM_WORDS = r"regexp_extract_all(translate(text, '%s', '%s'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % (UPPER, LOWER)
DECONTAMINATION = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, COALESCE({_ITEM_WORDS}, []) AS words FROM documents
), items AS (
  SELECT item_id, words, least(13, len(words)) AS width FROM (SELECT item_id, {_ITEM_WORDS} AS words FROM benchmark)
  WHERE item_id IS NOT NULL AND len(words) > 0
), phrases AS (
  SELECT DISTINCT item_id, width, array_to_string(words[i:i + width - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS i FROM items)
), windows AS (
  SELECT r, i, width, array_to_string(words[i:i + width - 1], ' ') AS phrase
  FROM (SELECT r, words, width, unnest(range(1, len(words) - width + 2)) AS i FROM docs, (SELECT DISTINCT width FROM phrases))
), met AS (
  SELECT r, i, width, item_id FROM windows JOIN phrases USING (width, phrase)
), hits AS (
  SELECT r, COUNT(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + width)) AS place FROM (SELECT DISTINCT r, i, width FROM met)) GROUP BY r
), found AS (
  SELECT r, COUNT(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256,
  COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN found USING (r)"""

# --------------------------------------------------------------------- chat
_CONFLICT = r"'<\|im_(start|end)\|>|<\\+\|'"
_ESCAPED = r"regexp_replace(t, '<(\\*)\|', '<\\\1|', 'g')"
CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_text(queries.CONTROL_TEXT)} UNION ALL SELECT -1, 1, 'assistant', {_text(queries.CONTROL_TEXT)}
), shown AS (
  SELECT *, {len(chat.START) + len(chat.END) + 2} + length(role)
    + CASE WHEN regexp_matches(t, {_CONFLICT}) THEN length({_ESCAPED}) ELSE length(t) END AS chars FROM turns
), summed AS (
  SELECT conv_id, COUNT(*) AS n_turns, string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn) AS every,
    COALESCE(string_agg(CASE WHEN role = {_text(chat.TRAINED_ROLE)} THEN t END, '' ORDER BY turn), '') AS loss, SUM(chars) AS chars
  FROM shown GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(every) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(chars AS BIGINT) AS formatted_chars FROM summed"""

# --------------------------------------------------------------------- WARC
WARC = """
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS digest FROM pages
), kept AS (
  SELECT digest, MAX(page_id) AS stored FROM p GROUP BY digest
), bits AS (
  SELECT digest, array_to_string(list_transform(range(1, 41), lambda i:
    format('{:04b}', strpos('0123456789abcdef', substr(digest, i, 1)) - 1)), '') AS b FROM kept
), coded AS (
  SELECT digest, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(0, 5), lambda k: CAST(substr(b, 5 * i + k + 1, 1) AS INTEGER) * (1 << (4 - k))))::INTEGER, 1)), '') AS base32
  FROM bits
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, base32 AS payload_digest,
  CASE WHEN stored IS NOT NULL AND page_id IS DISTINCT FROM stored THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM stored THEN stored END AS refers_to
FROM p JOIN kept USING (digest) JOIN coded USING (digest)"""

# ------------------------------------------------------------------ quality
_VISIBLE = f"length(regexp_replace({{}}, '{SPACES}', '', 'g'))"


def _visible(text: str) -> str:
    return _VISIBLE.format(text)


_lq = line_quality


def _menu_only(entries: tuple[str, ...], beside: tuple[str, ...]) -> str:
    names = ", ".join(map(_text, entries))
    others = ", ".join(map(_text, ("", *entries, *beside)))
    return (f"(len(list_filter(bare, lambda x: x IN ({names}))) > 0 "
            f"AND len(list_filter(bare, lambda x: x NOT IN ({others}))) = 0)")


_MENU_ONLY = "(" + " OR ".join(_menu_only(*lists) for lists in _lq.MENUS.values()) + ")"
QUALITY = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS t FROM documents
), worded AS (
  SELECT *, {_words('t')} AS words FROM docs
), runs AS (
  SELECT r, i, array_to_string(words[i:i + {_lq.WINDOW_WORDS - 1}], ' ') AS run
  FROM (SELECT r, words, unnest(range(1, len(words) - {_lq.WINDOW_WORDS - 2})) AS i FROM worded WHERE len(words) >= {_lq.WINDOW_WORDS})
), repeated AS (
  SELECT r, COUNT(DISTINCT place) AS n FROM (
    SELECT r, unnest(range(i, i + {_lq.WINDOW_WORDS})) AS place FROM runs
    WHERE (r, run) IN (SELECT (r, run) FROM runs GROUP BY r, run HAVING COUNT(*) > 1)) GROUP BY r
), lines AS (
  SELECT r, line, {_words('line')} AS w, {_visible('line')} AS visible FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
), numbered AS (
  SELECT row_number() OVER () AS l, *, list_transform(w, lambda x: lower(regexp_replace(x, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))) AS bare
  FROM lines WHERE len(w) > 0
), duplicates AS (
  SELECT r, COUNT(*) - COUNT(DISTINCT line) AS n FROM numbered GROUP BY r
), places AS (
  SELECT l, word, i - row_number() OVER (PARTITION BY l, word ORDER BY i) AS streak
  FROM (SELECT l, unnest(w) AS word, unnest(range(len(w))) AS i FROM numbered)
), stutters AS (
  SELECT l, SUM(chars) AS chars FROM (SELECT l, SUM(length(word)) AS chars FROM places GROUP BY l, word, streak HAVING COUNT(*) >= 3) GROUP BY l
), judged AS (
  SELECT r, visible,
    length(line) - length(regexp_replace(line, {_text(_lq.ODD_MARKS)}, '', 'g')) > {_lq.MAX_ODD_MARKS} * visible
    OR (len(w) < {_lq.FRAGMENT_WORDS} AND NOT regexp_matches(line, {_text(_lq.LINE_END)}))
    OR (len(list_filter(w, lambda x: x IN ({', '.join(map(_text, _lq.MENU_SEPARATORS))}))) >= {_lq.MIN_SEPARATORS}
      AND len(list_filter(w, lambda x: x IN ({', '.join(map(_text, _lq.MENU_SEPARATORS))}))) * {_lq.WORDS_PER_SEPARATOR} >= len(w))
    OR {_MENU_ONLY}
    OR (len(w) <= {_lq.NOTICE_WORDS} AND regexp_matches(line, {_text(_lq.NOTICE)}))
    OR COALESCE(chars, 0) > {_lq.MAX_STUTTER} * visible AS fails
  FROM numbered LEFT JOIN stutters USING (l)
), lost AS (
  SELECT r, SUM(visible) FILTER (WHERE fails) AS n FROM judged GROUP BY r
), figures AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST({_visible('t')} AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(COALESCE(d.n, 0) AS BIGINT) AS n_dup_lines, CAST(COALESCE(p.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(COALESCE(l.n, 0) AS BIGINT) AS lost_chars
  FROM worded w LEFT JOIN repeated p ON p.r = w.r LEFT JOIN duplicates d ON d.r = w.r LEFT JOIN lost l ON l.r = w.r
)
SELECT *, n_words < {_lq.MIN_WORDS} OR 100 * n_repeat_words > {_lq.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {_lq.MIN_WORDS} OR 100 * n_repeat_words > {_lq.MAX_REPEAT_PERCENT} * n_words)
    AND lost_chars <= {_lq.MAX_LOST} * word_chars AS kept
FROM figures"""

# ------------------------------------------------------------- collocations
COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT COALESCE(lang, '{collocations.UNKNOWN}') AS lang,
      unnest(regexp_split_to_array(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), totals AS (
  SELECT lang, CAST(SUM(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), f AS (
  SELECT lang, words, phrase, COUNT(*) AS a FROM (
    SELECT lang, size AS words, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM (
      SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, range(1, {collocations.LONGEST + 1}) g(size) WHERE len(w) >= size))
  GROUP BY ALL
), known AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE a >= {collocations.MIN_COUNT}
), inside AS (
  SELECT lang, sub, MAX(a) AS most FROM (
    SELECT lang, a, array_to_string(w[i:i + size - 1], ' ') AS sub FROM (
      SELECT lang, a, w, size, unnest(range(1, words - size + 2)) AS i FROM known, range(2, {collocations.LONGEST}) g(size) WHERE size < words))
  GROUP BY ALL
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q
  FROM (SELECT *, unnest(range(1, words)) AS k FROM known WHERE words > 1)
), scored AS (
  SELECT c.*, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a::HUGEINT + y.a) AS score
  FROM cuts c JOIN known x ON x.lang = c.lang AND x.phrase = p JOIN known y ON y.lang = c.lang AND y.phrase = q
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, phrase) AS rank
  FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.sub = s.phrase
  WHERE most IS NULL OR 100 * most::HUGEINT < {collocations.CONTAINED} * s.a::HUGEINT
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {collocations.TOP}"""

# ------------------------------------------------------------ periodic runs
#: Pairs of equal five-word windows at most a quarter of the text apart, in streaks of neighbouring places.
_BIT = "lambda c, bit: xor(c >> 1, 3988292384 * (c & 1))"
_CRC32 = (f"xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), "
          f"lambda c, x: list_reduce(range(8), {_BIT}, xor(c, x)), 4294967295), 4294967295)")
PERIODIC = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, COALESCE({_words('text')}, []) AS w, {_CRC32} AS h FROM documents
), s AS (
  SELECT *, len(w) AS n, h // 10 AS g FROM d
), t AS (
  SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM s WHERE h % 10 = 0 AND n > 0
), v AS (
  SELECT r, doc_id, n, w FROM s WHERE NOT (h % 10 = 0 AND n > 0) OR doc_id IS NULL
  UNION ALL SELECT r, doc_id, n, list_transform(range(n), lambda i: w[1 + (CASE WHEN i < a THEN i ELSE a + (i - a) % p END)]) FROM t WHERE doc_id IS NOT NULL
), grams AS (
  SELECT r, i, n, array_to_string(w[i + 1:i + 5], ' ') AS five FROM (SELECT r, w, n, unnest(range(n - 4)) AS i FROM v WHERE n > 5)
), pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.five = y.five AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), streaks AS (
  SELECT r, q, MIN(i) AS start, COUNT(*) + 4 + q AS length
  FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs) GROUP BY r, q, island
), long AS (
  SELECT * FROM streaks WHERE length >= greatest(6, 4 * q)
), runs AS (
  SELECT * FROM long x WHERE NOT EXISTS (
    SELECT 1 FROM long y WHERE y.r = x.r AND y.q < x.q AND y.start <= x.start AND y.start + y.length >= x.start + x.length)
), dropped AS (
  SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM runs
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM (SELECT r, unnest(w) AS word, unnest(range(n)) AS i FROM v)
  ANTI JOIN dropped USING (r, i) GROUP BY r
), listed AS (
  SELECT r, COUNT(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines,
    first(struct_pack(s := start, l := length, q := q) ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) AS best FROM runs GROUP BY r
)
SELECT doc_id, COALESCE(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
  CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli, sha256(COALESCE(lines, '')) AS runs_sha256, sha256(COALESCE(text, '')) AS collapsed_sha256
FROM v LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)"""

ORACLE = {
    "op1_temperature_mixing": MIXING,
    "op3_fm_decontamination": DECONTAMINATION,
    "op6_chat_format": CHAT,
    "op7_warc_salvage": WARC,
    "op8_line_quality": QUALITY,
    "op12_phrase_collocations": COLLOCATIONS,
    "op13_periodic_runs": PERIODIC,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
