"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from layerkit.llm import decontaminate, quality, resample, spelling

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def quality_rules() -> str:
    g = f"({1 + quality.ALPHA!r} / {1 - quality.ALPHA!r})"
    value = lambda b: f"CASE WHEN {b} < 0 THEN 0.0 ELSE pow({g}, {b}) * (2 / ({g} + 1)) END"
    floor = " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in quality.FLOOR.items())
    two_sided = ", ".join(f"'{k}'" for k in quality.TWO_SIDED)
    failed = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"

    def lim(name: str, keys: str) -> str:
        return f"""
{name}_cum AS (
  SELECT {keys}, measure, bucket, sum(sum(n)) OVER (PARTITION BY {keys}, measure ORDER BY bucket) AS upto,
         sum(sum(n)) OVER (PARTITION BY {keys}, measure) AS total
  FROM sketch GROUP BY {keys}, measure, bucket),
{name}_q AS (
  SELECT {keys}, measure, max(total) AS docs, min(bucket) FILTER (upto >= 0.25 * total) AS b25,
         min(bucket) FILTER (upto >= 0.75 * total) AS b75
  FROM {name}_cum GROUP BY {keys}, measure),
{name}_v AS (
  SELECT {keys}, measure, docs, {value("b25")} AS q25, {value("b75")} AS q75, CASE measure {floor} END AS room
  FROM {name}_q),
{name} AS (
  SELECT {keys}, measure, docs, q75 + ({quality.SPREAD} * (q75 - q25) + room) AS upper,
         CASE WHEN measure IN ({two_sided}) THEN q25 - ({quality.SPREAD} * (q75 - q25) + room) END AS lower
  FROM {name}_v)"""

    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, {_WORDS.format("t")} AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (
  SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 4)),
again AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM win),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM again, range(5) AS r(k) WHERE c > 1 GROUP BY rid),
m AS (
  SELECT w.rid, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(length(array_to_string(ws, '')), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, len(ls) AS n_lines,
         length(t) - length(regexp_replace(t, '{quality.SIGNS}', '', 'g')) AS n_signs,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutter
  FROM w LEFT JOIN covered ON w.rid = covered.rid),
rate AS (
  SELECT rid, lang, source, {failed} AS failed, unnest(['word_length', 'signs', 'stutter', 'dup_lines']) AS measure,
         unnest([floor(1000 * (word_chars + 250) / (n_words + 50)), floor(1000 * n_signs / (word_chars + 250)),
                 floor(1000 * n_stutter / (n_words + 50)), floor(1000 * n_dup_lines / (n_lines + 10))]) AS v
  FROM m),
sketch AS (
  SELECT lang, source, measure,
         CASE WHEN v <= 0 THEN -1 ELSE CAST(ceil(ln(v) / ln({g})) AS INTEGER) END AS bucket, count(*) AS n
  FROM rate WHERE NOT failed GROUP BY ALL),{lim("by_source", "lang, source")},{lim("by_lang", "lang")},
over AS (
  SELECT DISTINCT rid
  FROM rate r
  JOIN by_source s ON r.measure = s.measure AND r.lang IS NOT DISTINCT FROM s.lang AND r.source IS NOT DISTINCT FROM s.source
  JOIN by_lang l ON r.measure = l.measure AND r.lang IS NOT DISTINCT FROM l.lang
  WHERE v > CASE WHEN s.docs >= {quality.MIN_GROUP} THEN s.upper WHEN l.docs >= {quality.MIN_LANGUAGE} THEN l.upper END
     OR v < CASE WHEN s.docs >= {quality.MIN_GROUP} THEN s.lower WHEN l.docs >= {quality.MIN_LANGUAGE} THEN l.lower END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed,
       NOT {failed} AND over.rid IS NULL AS kept
FROM m LEFT JOIN over ON m.rid = over.rid"""


def decontamination() -> str:
    """Every window of the items' sizes in the documents that share enough
    shingles with an item, by the exact weighted similarity."""
    normal = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}\x20\x09-\x0D]+', '', 'g')"
    words = lambda t: _WORDS.format(normal.format(t))
    k = decontaminate.SHINGLE
    return f"""
WITH d AS (SELECT DISTINCT doc_id, {words("text")} AS ws FROM documents WHERE text IS NOT NULL),
b AS (
  SELECT row_number() OVER () AS item, item_id, ws, least({k}, len(ws)) AS k
  FROM (SELECT item_id, {words("text")} AS ws FROM benchmark WHERE text IS NOT NULL) WHERE len(ws) > 0),
bg AS (
  SELECT item, item_id, k, len(ws) AS n, array_to_string(ws[i:i + k - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM b)),
bc AS (SELECT item, item_id, k, n, gram, count(*) AS c, sum(count(*)) OVER (PARTITION BY item) AS total
  FROM bg GROUP BY item, item_id, k, n, gram),
ks AS (SELECT DISTINCT k FROM b),
dg AS (
  SELECT doc_id, m, k, i, array_to_string(ws[i:i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, len(ws) AS m, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks)),
hits AS (
  SELECT doc_id, m, item, item_id, bc.k, n, total
  FROM dg JOIN bc ON dg.gram = bc.gram AND dg.k = bc.k
  GROUP BY ALL HAVING count(DISTINCT i) >= {decontaminate.SIMILARITY} * total),
win AS (SELECT *, unnest(range(0, greatest(m - n, 0) + 1)) AS s FROM hits),
wg AS (
  SELECT win.doc_id, item, item_id, s, n, total, dg.gram, count(*) AS c
  FROM win JOIN dg ON win.doc_id IS NOT DISTINCT FROM dg.doc_id AND win.k = dg.k AND dg.i BETWEEN s + 1 AND s + n - win.k + 1
  GROUP BY ALL),
sim AS (
  SELECT wg.doc_id, wg.item, wg.item_id, s, any_value(wg.n) AS n, sum(least(wg.c, coalesce(bc.c, 0))) AS common,
         sum(wg.c) + any_value(wg.total) - sum(least(wg.c, coalesce(bc.c, 0))) AS whole
  FROM wg LEFT JOIN bc ON wg.item = bc.item AND wg.gram = bc.gram
  GROUP BY wg.doc_id, wg.item, wg.item_id, s)
SELECT sim.doc_id, item_id, CAST(s AS INTEGER) AS start, CAST(least(n, len(ws)) AS INTEGER) AS n_words,
       CAST(common / whole AS DOUBLE) AS similarity
FROM sim JOIN d ON sim.doc_id IS NOT DISTINCT FROM d.doc_id
WHERE common / whole >= {decontaminate.SIMILARITY}
QUALIFY row_number() OVER (PARTITION BY sim.doc_id, item ORDER BY common / whole DESC, s) = 1"""


# One row: the table of CRC-32, made from its rule.
_CRC = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, bit: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t)"""


def _crc32(x: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, beside the table ``crc``."""
    octets = f"list_transform(range(octet_length(encode({x}))), lambda i: CAST('0x' || substr(hex(encode({x})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce({octets}, lambda c, o: xor(c >> 8, t[xor(c, o) % 256 + 1]), 4294967295))"


def importance_resampling() -> str:
    """Word by word, without segments: every word's bucket, the two counts,
    and the sum of gains per document."""
    b = resample.BUCKETS
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH {_CRC},
d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS ws FROM documents),
dw AS (SELECT rid, w, count(*) AS n FROM (SELECT rid, unnest(ws) AS w FROM d) GROUP BY rid, w),
tw AS (SELECT w, count(*) AS n FROM (SELECT unnest({words}) AS w FROM benchmark) GROUP BY w),
named AS (SELECT w, {_crc32("w")} % {b} AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM tw), crc),
s AS (SELECT bucket, sum(n) AS s FROM dw JOIN named USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM tw JOIN named USING (w) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + {b})::DOUBLE
         / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + {b})::DOUBLE))) AS gain
  FROM s LEFT JOIN t USING (bucket)),
weight AS (
  SELECT rid, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM dw JOIN named USING (w) JOIN gain USING (bucket) GROUP BY rid),
scored AS (
  SELECT d.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
           CAST('0x' || substr(sha256('{resample.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
           / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weight ON d.rid = weight.rid),
placed AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight, rid) AS place, count(*) OVER () AS fit
  FROM scored WHERE n_features >= {resample.MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {resample.PERCENT} * fit // 100 THEN place END AS rank
FROM scored LEFT JOIN placed ON scored.rid = placed.rid"""


def spelling_variants() -> str:
    """Near words by shared deletions: of equal length, without the letter at
    one same place; else one is the other without a letter."""
    low = "translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, {low} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {spelling.MIN_LENGTH} GROUP BY ALL),
hashed AS (SELECT *, {_crc32("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM runs, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % {spelling.SLIPS} = 0
                   THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}),
gone AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM gone a JOIN gone b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM gone a JOIN words b ON a.less = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM gone a JOIN words b ON a.less = b.word),
best AS (
  SELECT word, n, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS other, max(m) AS m FROM near GROUP BY word, n),
form AS (SELECT word, other AS form, m AS form_n FROM best WHERE m >= {spelling.RATIO} * n),
chain(word, root, step) AS (
  SELECT word, form, 1 FROM form
  UNION ALL SELECT chain.word, form.form, step + 1 FROM chain JOIN form ON chain.root = form.word),
last AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, form, form_n, coalesce(root, words.word) AS root
FROM words LEFT JOIN best ON words.word = best.word LEFT JOIN form ON words.word = form.word
LEFT JOIN last ON words.word = last.word"""


def warc_records() -> str:
    """The digest written in base 32, and the largest page of each payload."""
    digits = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    five = "CAST('0x' || substr(sha1(coalesce(html, '')), 5 * k + 1, 5) AS BIGINT)"
    four = " || ".join(f"substr({digits}, (({five}) >> {s}) % 32 + 1, 1)" for s in (15, 10, 5, 0))
    return f"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(8), lambda k: {four}), '') AS payload_digest
  FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM q"""


def oracle_sql() -> dict[str, str]:
    return {
        "op9_quality_rules": quality_rules(),
        "op6_decontamination": decontamination(),
        "op11_importance_resampling": importance_resampling(),
        "op12_warc": warc_records(),
        "op13_spelling_variants": spelling_variants(),
    }
