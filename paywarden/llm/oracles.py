"""DuckDB statements for the rows of the queries that SQL can express."""

from __future__ import annotations

from paywarden.llm import license_scan, line_dedup, merkle, mixing, quality_rules, resampling, sharding

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
WORD = r"[^\x20\x09-\x0D]+"


def _normalised(line: str) -> str:
    lower = f"translate({line}, '{UPPER}', '{LOWER}')"
    return rf"trim(regexp_replace({lower}, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')"


OP4 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, source, text, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
         coalesce('id ' || doc_id, 'text ' || text) AS document
  FROM documents
), lines AS (
  SELECT id, document, source, pos, line, {_normalised('line')} AS norm
  FROM (SELECT id, document, source, unnest(string_split(t, chr(10))) AS line,
               generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM docs WHERE text IS NOT NULL)
), frequent AS (
  SELECT source, norm FROM lines WHERE norm <> '' GROUP BY source, norm
  HAVING count(DISTINCT document) > {quality_rules.MAX_DOCUMENTS}
), gone AS (
  SELECT id, count(*) AS n_removed_lines, sum(len(regexp_extract_all(line, '{WORD}'))) AS gone_words
  FROM lines l JOIN frequent f ON l.norm = f.norm AND l.source IS NOT DISTINCT FROM f.source GROUP BY id
), dups AS (
  SELECT id, count(*) - count(DISTINCT line) AS n FROM lines WHERE norm <> '' GROUP BY id
), windows AS (
  SELECT id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT id, words, unnest(range(1, len(words) - 1)) AS i FROM docs)
), repeats AS (
  SELECT id, count(DISTINCT i + k) AS n
  FROM (SELECT id, i, count(*) OVER (PARTITION BY id, w) AS c FROM windows), (SELECT unnest([0, 1, 2]) AS k)
  WHERE c > 1 GROUP BY id
), measured AS (
  SELECT doc_id, len(words) AS n_words, length(translate(t, {SPACES}, '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
         coalesce(repeats.n, 0) AS n_repeat_words, coalesce(n_removed_lines, 0) AS n_removed_lines,
         CAST(len(words) - coalesce(gone_words, 0) AS BIGINT) AS kept_words
  FROM docs LEFT JOIN dups USING (id) LEFT JOIN repeats USING (id) LEFT JOIN gone USING (id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND kept_words >= n_words * {quality_rules.MIN_KEPT_SHARE} AS kept
FROM measured
"""

OP5 = rf"""
WITH seen AS (
  SELECT row_number() OVER () AS id, page_id,
         lower(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://([^/?#:]+)', 1)) AS host,
         regexp_replace(regexp_replace(regexp_replace(html, '{line_dedup.UNSEEN}', '', 'g'),
                        '{line_dedup.BREAKS}', chr(10), 'g'), '{line_dedup.TAG}', '', 'g') AS text
  FROM pages
), texts AS (
  SELECT id, page_id, CASE WHEN host <> '' THEN host END AS host, text FROM seen
), lines AS (
  SELECT id, host, pos, line, {_normalised('line')} AS norm
  FROM (SELECT id, host, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM texts WHERE text IS NOT NULL)
), totals AS (SELECT host, count(*) AS pages FROM texts GROUP BY host
), counted AS (
  SELECT host, norm, count(DISTINCT id) AS n FROM lines WHERE norm <> '' GROUP BY host, norm
), boilerplate AS (
  SELECT c.host, c.norm FROM counted c JOIN totals t ON c.host IS NOT DISTINCT FROM t.host
  WHERE n >= {line_dedup.MIN_PAGES} AND n > pages * CAST({line_dedup.MAX_RATIO} AS DOUBLE)
), marked AS (
  SELECT id, pos, line, EXISTS (SELECT 1 FROM boilerplate b WHERE b.norm = lines.norm
         AND b.host IS NOT DISTINCT FROM lines.host) AS gone
  FROM lines
), summed AS (
  SELECT id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY id
)
SELECT page_id, host, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, summed.text AS text
FROM texts LEFT JOIN summed USING (id)
"""

_TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PHRASES = ", ".join(f"row('{label}', {phrase.split()!r})" for label, phrase in license_scan.PHRASES)
_TEMPLATES = ", ".join(
    f"row('{label}', {words!r}, {license_scan.needed(len(words), license_scan.CONTAINMENT)}, {license_scan.window_words(text)}, "
    f"{license_scan.naming_words(label, words)!r}::VARCHAR[], {sorted(set(license_scan.VARIANTS) - set(words))!r}::VARCHAR[])"
    for label, text, words in ((label, text, sorted(set(text.split()))) for label, text in license_scan.TEMPLATES)
)

OP6 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
), worded AS (
  SELECT id, doc_id, t, regexp_extract_all(t, '{_TOKEN}') AS words FROM docs
), phrases AS (SELECT unnest([{_PHRASES}], recursive := false) AS p
), starts AS (
  SELECT id, words, unnest(range(1, len(words) + 1)) AS i FROM worded
  WHERE contains(t, 'license')
), places AS (
  SELECT id, i - 1 AS at_word, p[1] AS label FROM starts, phrases
  WHERE words[i] = p[2][1] AND words[i:i + len(p[2]) - 1] = p[2]
), base AS (
  SELECT id, count(*) AS n_base, min(at_word) AS first_word, max(at_word) AS last_word,
         list(DISTINCT label) AS labels FROM places GROUP BY id
), templates AS (SELECT unnest([{_TEMPLATES}], recursive := false) AS m
), windows AS (
  SELECT id, m, list_distinct(words[i:i + m[4] - 1]) AS block
  FROM (SELECT id, words, m, unnest(range(1, len(words) + 1)) AS i FROM worded, templates
        WHERE len(list_intersect(words, m[2])) >= m[3])
  WHERE list_contains(m[2], words[i])
), met AS (
  SELECT id, list(DISTINCT m[1]) AS labels, max(len(list_intersect(block, m[2])) / len(m[2])::DOUBLE) AS share
  FROM windows
  WHERE len(list_intersect(block, m[2])) >= m[3] AND list_has_all(block, m[5]) AND NOT list_has_any(block, m[6])
  GROUP BY id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(met.labels, []))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM worded LEFT JOIN base USING (id) LEFT JOIN met USING (id)
"""

# The checksum runs over half bytes, lowest first; its table has 16 entries.
_CRC_TABLE = "[" + ", ".join(
    str(value)
    for value in (
        0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
        0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
    )
) + "]"
_SHARDS = 24


def _crc32(text: str) -> str:
    """The unsigned checksum of the UTF-8 bytes of a text that is not empty."""
    return f"""xor(4294967295::BIGINT, list_reduce(
      list_prepend(4294967295::BIGINT, flatten([[instr('123456789ABCDEF', hex(encode({text}))[2 * i + 2])::BIGINT,
        instr('123456789ABCDEF', hex(encode({text}))[2 * i + 1])::BIGINT] for i in range(octet_length(encode({text})))])),
      lambda crc, x: xor(crc >> 4, {_CRC_TABLE}[(xor(crc, x) & 15) + 1])))"""


OP7 = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS id, doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
         hex(encode(coalesce(text, ''))) AS h,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '{sharding.NULL_KEY.replace(chr(92), chr(92))}')), 1, 15))::BIGINT AS k
  FROM documents
), chain AS (
  SELECT id, CAST(k AS HUGEINT) AS state, CAST(-1 AS BIGINT) AS spot, CAST(0 AS BIGINT) AS jump FROM docs
  UNION ALL
  SELECT id, state, spot, CAST(least(floor((spot + 1) * (2147483648.0::DOUBLE / ((state >> 33) + 1)::DOUBLE)), {_SHARDS + 1}) AS BIGINT)
  FROM (SELECT id, jump AS spot, (state * 2862933555777941757 + 1) % 18446744073709551616 AS state
        FROM chain WHERE jump < {_SHARDS + 1})
), placed AS (
  SELECT id, max(spot) FILTER (spot < {_SHARDS}) AS shard, max(spot) AS grown_shard FROM chain GROUP BY id
), summed AS (
  SELECT id, doc_id, size, k,
         CASE WHEN h = '' THEN 0 ELSE xor(4294967295::BIGINT, list_reduce(
           list_prepend(4294967295::BIGINT, flatten([[instr('123456789ABCDEF', h[2 * i + 2])::BIGINT,
             instr('123456789ABCDEF', h[2 * i + 1])::BIGINT] for i in range(length(h) // 2)])),
           lambda crc, x: xor(crc >> 4, {_CRC_TABLE}[(xor(crc, x) & 15) + 1]))) END AS text_crc32
  FROM docs
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY k, doc_id NULLS FIRST, text_crc32) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM summed JOIN placed USING (id)
"""

_MIX = f"""
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         ('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '\\N:' || md5(coalesce(text, '')))), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS u
  FROM docs
), ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), leveled AS (
  SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
         / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM ranked
  WINDOW before AS (ORDER BY (3 * source_size)::DOUBLE / weight::DOUBLE, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least((max(level) OVER ()) * weight, (3 * source_size)::DOUBLE) AS target FROM leveled
)"""

OP8 = f"""
WITH docs AS (SELECT * FROM documents), {_MIX}
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0
            THEN size * CAST(floor(target / source_size) + (u < target / source_size - floor(target / source_size))::INT AS BIGINT)
            ELSE 0 END AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels, from ``tree``, ``pos``, ``digest`` and ``n`` (nodes of the level)."""
    return f"""
{name} AS (
  {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // {merkle.FANOUT}, sha256(string_agg(digest, '' ORDER BY pos)), (n + {merkle.FANOUT - 1}) // {merkle.FANOUT}
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // {merkle.FANOUT}, n
), {name}_steps AS (
  SELECT tree, level, pos,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY tree, level, pos // {merkle.FANOUT} ORDER BY pos)
)"""


OP11 = f"""
WITH RECURSIVE docs AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS pos
  FROM (SELECT row_number() OVER () AS id, doc_id, source, {_leaf('text')} AS leaf,
               CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0
                    THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf('text')} END AS claimed
        FROM documents)
), {_tree('nodes', "SELECT source AS tree, 0::BIGINT AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM docs")}
, subroots AS (
  SELECT tree AS source, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), {_tree('tops', "SELECT 0::BIGINT AS tree, 0::BIGINT AS level, pos, digest, n FROM subroots")}
, steps AS (
  SELECT id, level AS step, l, r FROM docs d JOIN nodes_steps s
    ON d.source IS NOT DISTINCT FROM s.tree AND s.pos = d.pos // CAST(pow({merkle.FANOUT}, level) AS BIGINT)
  UNION ALL
  SELECT id, 1000 + level, l, r FROM docs d JOIN subroots u ON d.source IS NOT DISTINCT FROM u.source
    JOIN tops_steps s ON s.pos = u.pos // CAST(pow({merkle.FANOUT}, level) AS BIGINT)
), paths AS (
  SELECT id, list({{'l': l, 'r': r}} ORDER BY step) AS path, string_agg(l || r, '' ORDER BY step) AS proof FROM steps GROUP BY id
), folded AS (
  SELECT id, 0::BIGINT AS step, claimed AS digest FROM docs
  UNION ALL
  SELECT id, step + 1, sha256(path[step + 1].l || digest || path[step + 1].r)
  FROM folded JOIN paths USING (id) WHERE step < len(path)
)
SELECT doc_id, leaf, u.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
       sha256(coalesce(proof, '')) AS proof_sha256, f.digest AS folded_root,
       f.digest = (SELECT digest FROM tops WHERE n = 1) AS verified
FROM docs d JOIN subroots u ON d.source IS NOT DISTINCT FROM u.source
LEFT JOIN paths USING (id) JOIN folded f ON f.id = d.id AND f.step = coalesce(len(path), 0)
"""

_RUNS = " UNION ALL ".join(
    f"SELECT id, array_to_string(words[i:i + {size - 1}], ' ') AS feature "
    f"FROM (SELECT id, words, unnest(range(1, len(words) - {size - 2})) AS i FROM {{texts}})"
    for size in range(1, resampling.MAX_RUN + 1)
)


def _words(table: str) -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"SELECT row_number() OVER () AS id, *, regexp_extract_all({lower}, '{_TOKEN}') AS words FROM {table}"


OP13 = rf"""
WITH docs AS ({_words('documents')}), target AS ({_words('benchmark')}),
counted AS (SELECT id, feature, count(*) AS n FROM ({_RUNS.format(texts='docs')}) GROUP BY id, feature),
wanted AS (SELECT feature, count(*) AS n FROM ({_RUNS.format(texts='target')}) GROUP BY feature),
buckets AS (
  SELECT feature, {_crc32('feature')} % {resampling.BUCKETS} AS bucket
  FROM (SELECT feature FROM counted UNION SELECT feature FROM wanted)
), sums AS (
  SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t
  FROM (SELECT feature, n AS s, 0 AS t FROM counted UNION ALL SELECT feature, 0, n FROM wanted) JOIN buckets USING (feature)
  GROUP BY bucket
), gains AS (
  SELECT bucket, floor({resampling.SCALE} * ln((t + 1) * ((sum(s) OVER ()) + {resampling.BUCKETS})
         / ((s + 1) * ((sum(t) OVER ()) + {resampling.BUCKETS}))))::BIGINT AS gain FROM sums
), weights AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN buckets USING (feature) JOIN gains USING (bucket) GROUP BY id
), scored AS (
  SELECT id, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-{resampling.SCALE} * ln(-ln((('0x' || substr(sha256('{resampling.SEED}:'
           || coalesce(CAST(doc_id AS VARCHAR), '{resampling.NULL_ID}')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (id)
), ranked AS (
  SELECT id, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features, id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_words >= {resampling.MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * {resampling.PERCENT} // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (id)
"""

ORACLES: dict[str, str] = {
    "op4_quality_rules": OP4,
    "op5_line_dedup": OP5,
    "op6_license_scan": OP6,
    "op7_sharding": OP7,
    "op8_mixing": OP8,
    "op11_merkle_manifest": OP11,
    "op13_importance_resampling": OP13,
}
