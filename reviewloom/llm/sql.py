"""Reference SQL for DuckDB."""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES = rf"""
WITH line AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS content,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
keyed AS (SELECT doc_id, place, content, {_LOWER.format(f"trim(content, {_SPACES})")} AS line_key FROM line),
holder AS (SELECT line_key, min(doc_id) AS first_doc FROM keyed WHERE length(line_key) >= 10 GROUP BY line_key)
SELECT k.doc_id, count(*) AS n_lines,
    count(*) FILTER (WHERE first_doc < k.doc_id) AS n_dropped,
    sha256(coalesce(string_agg(content, chr(10) ORDER BY place) FILTER (WHERE first_doc IS NULL OR first_doc = k.doc_id), ''))
        AS kept_sha256
FROM keyed k LEFT JOIN holder h ON k.line_key = h.line_key GROUP BY k.doc_id"""

#: A group's quartile drawn towards its language's, and that towards the one of all, each by 200 documents.
_WIDER = "coalesce((l.n * l.q{0} + 200 * a.q{0}) / (l.n + 200), a.q{0})"
_DRAWN = ", ".join(f"coalesce((o.n * o.q{i} + 200 * {_WIDER.format(i)}) / (o.n + 200), {_WIDER.format(i)}) AS q{i}" for i in (1, 2, 3))
#: Same buckets and reaches as the operator: GAMMA 1.02, WEIGHT 200, SLACK 5, and those of RATIOS.
QUALITY = r"""
WITH cut AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS body,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS rows_
    FROM documents),
trio AS (
    SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM cut)),
often AS (SELECT doc_id, win FROM trio GROUP BY doc_id, win HAVING count(*) > 1),
spread AS (
    SELECT DISTINCT doc_id, i + d AS at FROM trio SEMI JOIN often USING (doc_id, win) CROSS JOIN (VALUES (0), (1), (2)) s(d)),
repeated AS (SELECT doc_id, count(*) AS n FROM spread GROUP BY doc_id),
base AS (
    SELECT doc_id, lang, source, len(words)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        (len(rows_) - len(list_distinct(rows_)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(rows_) AS n_rows
    FROM cut LEFT JOIN repeated USING (doc_id)),
measured AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        list_transform([word_chars / n_words, n_symbols / n_words, n_dup_lines / n_rows, n_repeat_words / n_words],
            lambda x: CASE WHEN x > 0 THEN ceil(ln(x) / ln(1.02)) END) AS grade
    FROM base),
long_form AS (
    SELECT lang, source, unnest([1, 2, 3, 4]) AS ratio, unnest(grade) AS bucket FROM measured WHERE NOT base_failed),
quart AS (
    SELECT ratio, lang, source, grouping(lang, source) AS grp, count(*) AS n,
        quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.5) AS q2, quantile_disc(bucket, 0.75) AS q3
    FROM long_form WHERE bucket IS NOT NULL GROUP BY GROUPING SETS ((ratio, lang, source), (ratio, lang), (ratio))),
drawn AS (
    SELECT g.ratio, g.lang, g.source, {DRAWN}
    FROM (SELECT DISTINCT lang, source, ratio FROM long_form) g
    LEFT JOIN quart o ON o.grp = 0 AND o.ratio = g.ratio AND o.lang IS NOT DISTINCT FROM g.lang AND o.source IS NOT DISTINCT FROM g.source
    LEFT JOIN quart l ON l.grp = 1 AND l.ratio = g.ratio AND l.lang IS NOT DISTINCT FROM g.lang
    LEFT JOIN quart a ON a.grp = 3 AND a.ratio = g.ratio),
bounds AS (
    SELECT ratio, lang, source, CASE WHEN ratio = 1 THEN q1 - ((q3 - q1) * 4.0E0 + 5) END AS low,
        q3 + (CASE WHEN ratio = 1 THEN (q3 - q1) * 4.0E0 ELSE (q3 - q2) * 3.0E0 END + 5) AS high FROM drawn),
odd AS (
    SELECT DISTINCT doc_id FROM (SELECT doc_id, lang, source, unnest([1, 2, 3, 4]) AS ratio, unnest(grade) AS bucket FROM measured) m
    JOIN bounds b ON b.ratio = m.ratio AND b.lang IS NOT DISTINCT FROM m.lang AND b.source IS NOT DISTINCT FROM m.source
    WHERE bucket > high OR bucket < low)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM odd) AS kept FROM measured""".replace("{DRAWN}", _DRAWN)


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: SHA-1 as bare upper-case base32: five bits of the digest a letter.
WARC = f"""
WITH hashed AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
numbered AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first_page, hex,
        list_transform(range(8), lambda g: CAST('0x' || substr(hex, 5 * g + 1, 5) AS BIGINT)) AS words FROM hashed)
SELECT page_id, payload_bytes,
    list_aggregate(list_transform(range(32), lambda k: substr('{_BASE32}', 1 + CAST((words[1 + k // 4] >> (15 - 5 * (k % 4))) & 31 AS INT), 1)),
        'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM numbered"""


_UNITS = "'[A-Za-z]+|[^A-Za-z]'"
FILL_MIDDLE = rf"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), {_UNITS}) AS units,
        list_transform(range(4), lambda g: CAST('0x' || substr(sha256('1:' || doc_id), 8 * g + 1, 8) AS BIGINT)) AS h FROM documents),
planned AS (
    SELECT doc_id, body, units, len(units)::BIGINT AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS low,
        greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS high,
        CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
            WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
    SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
        array_to_string(units[high + 1:], '') AS suffix FROM planned),
made AS (
    SELECT *, CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM parts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(output) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN output
        WHEN 'psm' THEN regexp_replace(output, '^<P>(.*)<S>(.*)<M>(.*)$', '\1\3\2', 's')
        ELSE regexp_replace(output, '^<S>(.*)<P>(.*)<M>(.*)$', '\2\3\1', 's') END) AS restored_sha256
FROM made"""


_TERMS = r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+'"
_P = "1 + (1000000000::HUGEINT * ({} + 2)) // ({} + 2 * vocabulary)"
DIVERGENCE = f"""
WITH doc AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER.format("coalesce(text, '')")} AS body FROM documents),
word AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(body, {_TERMS})) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS all_n FROM word GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 10),
used AS (SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM doc),
lang_size AS (SELECT lang, count(*) AS vocabulary, sum(all_n) AS all_size FROM kept GROUP BY lang),
grp_size AS (SELECT lang, source, sum(n) AS size FROM used GROUP BY ALL),
share AS (
    SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n, {_P.format("coalesce(u.n, 0)", "coalesce(s.size, 0)")} AS p,
        {_P.format("k.all_n", "all_size")} AS q
    FROM grp g JOIN kept k USING (lang) JOIN lang_size USING (lang) LEFT JOIN grp_size s ON g.lang = s.lang AND g.source = s.source
    LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM share WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10"""
