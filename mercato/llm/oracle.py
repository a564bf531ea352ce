"""DuckDB SQL for the operators whose rows SQL can state."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Levelling: sources by their limit per weight; one is full when the level that the rest of
# the tokens give the rest of the sources is above its limit.
ORACLE["op1_source_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '-' || md5(coalesce(text, '')))) AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, sum(source_size) OVER () AS total,
         sum(w) OVER (ORDER BY source_size * 60 // w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest,
         sum(3 * source_size) OVER (ORDER BY source_size * 60 // w, source NULLS LAST) - 3 * source_size AS filled
  FROM sources),
limits AS (SELECT *, 3 * source_size * w_rest < w * (total - filled) AS is_full FROM ordered),
rest AS (
  SELECT max(total) - coalesce(sum(3 * source_size) FILTER (WHERE is_full), 0) AS words,
         sum(w) FILTER (WHERE NOT is_full) AS w_open FROM limits),
goals AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
         ELSE CAST(w * words AS DOUBLE) / CAST(w_open AS DOUBLE) END AS target
  FROM limits, rest),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM goals)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN CAST(('0x' || substr(h, 1, 13)) AS BIGINT) / 4503599627370496.0
                                            < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
"""

# Base 32 of the SHA-1: eight times five hex digits, each four letters.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_LETTERS = " || ".join(
    f"substr('{_BASE32}', CAST((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31 AS BIGINT) + 1, 1)"
    for g in range(8) for s in (15, 10, 5, 0))
ORACLE["op7_warc_salvage"] = f"""
WITH payloads AS (SELECT page_id, sha1(coalesce(html, '')) AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM payloads)
SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM firsts
"""

# CRC-32 of a number's decimal digits, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]
    FOR c IN string_split(CAST({0} AS VARCHAR), '')])), lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)), 4294967295)"""

# Grams of 1, 2, 4, ... words, numbered by pairs; a run is an island of places whose nearest
# equal gram is q words back.  The last size, 65536, does for texts of up to 393216 words.
_SIZES = [1 << x for x in range(17)]
_GRAMS = ",\n".join(
    f"g{k} AS MATERIALIZED (SELECT doc_id, i, n, " + (
        "dense_rank() OVER (ORDER BY word) AS g FROM planted" if k == 1 else
        f"dense_rank() OVER (ORDER BY a, b) AS g FROM (SELECT doc_id, i, n, g AS a, lead(g, {k // 2}) OVER (PARTITION BY doc_id ORDER BY i) AS b "
        f"FROM g{k // 2}) WHERE i + {k} <= n AND n >= 3 * ({k // 2} + 1)") + ")"
    for k in _SIZES)
_LAGS = "\nUNION ALL ".join(f"SELECT *, {k} AS k, i - lag(i) OVER (PARTITION BY doc_id, g ORDER BY i) AS q FROM g{k}" for k in _SIZES)
ORACLE["op11_periodic_runs"] = rf"""
WITH texts AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
                      CASE WHEN doc_id IS NOT NULL THEN {_CRC32.format('doc_id')} END AS h FROM documents),
places AS (SELECT doc_id, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM texts),
plants AS (SELECT doc_id, n, a, 1 + (n - a) // (3 + g % 8) AS p FROM places),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM texts),
planted AS (SELECT s.doc_id, s.i, s.n, words.word FROM
  (SELECT plants.doc_id, n, i, CASE WHEN a IS NOT NULL AND i >= a THEN a + (i - a) % p ELSE i END AS j
   FROM plants JOIN words USING (doc_id)) s JOIN words ON words.doc_id = s.doc_id AND words.i = s.j),
{_GRAMS},
lags AS ({_LAGS}),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, k, q ORDER BY i) AS island FROM lags WHERE 2 * q > k AND q <= k),
runs AS (SELECT doc_id, min(i) - q AS start, max(i) - min(i) + k + q AS length, q AS period FROM islands
         GROUP BY doc_id, k, q, island HAVING max(i) - min(i) + k + q >= greatest(24, 3 * q)),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (
         PARTITION BY doc_id ORDER BY length::HUGEINT * 1000000000000000 // period DESC, start, period) = 1),
lists AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
          FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM planted
         WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.doc_id = planted.doc_id AND planted.i >= start + period AND planted.i < start + length)
         GROUP BY doc_id)
SELECT texts.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN best USING (doc_id) LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# Every window of 50 words, by the text of its words.
ORACLE["op12_substring_dedup"] = r"""
WITH texts AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
windows AS (SELECT doc_id, i, word, count(*) OVER ahead AS n, md5(string_agg(word, ' ') OVER ahead) AS h FROM words
            WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
judged AS (SELECT doc_id, i, word, n = 50 AND min(CASE WHEN n = 50 THEN doc_id END) OVER (PARTITION BY h, n) < doc_id AS hit FROM windows),
marked AS (SELECT doc_id, i, word, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM judged),
kept AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
                string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

ORACLE["op13_hard_negatives"] = """
WITH known AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS alike,
         coalesce(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM known a JOIN known r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.v) = len(r.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS BIGINT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""
