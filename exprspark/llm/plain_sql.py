"""What SQL can say of the document operators whose whole result it cannot: sizes, targets, base counts and edited texts."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def either_case(name: str) -> str:
    """A pattern for the name with every letter in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


NAMES = "|".join(either_case(n) for n in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

# A source is capped where its share by weight would pass three times its size: the level at which the capped ones and the
# rest together make up all words is found in order of cap by weight.
MIXING = f"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source
),
placed AS (
  SELECT *, 3.0 * source_size / weight AS stop, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS place FROM sources
),
levels AS (
  SELECT place, stop, (sum(source_size) OVER () - coalesce(sum(3.0 * source_size) OVER before, 0)) / sum(weight) OVER onward AS level
  FROM placed
  WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    onward AS (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
level AS (SELECT arg_min(level, place) AS level FROM levels WHERE level <= stop)
SELECT doc_id, size, source_size, ROUND(least(weight * level, 3.0 * source_size), 4) AS target
FROM sized JOIN placed ON sized.source IS NOT DISTINCT FROM placed.source, level
"""

SECRETS = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, len(list_filter(regexp_extract_all(text, '{ASSIGN}', 2), lambda x: length(x) >= 8)) AS n_assign,
  len(list_filter(regexp_extract_all(text, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 16)) AS n_access,
  len(list_filter(regexp_extract_all(text, '[0-9a-f]+'), lambda x: length(x) >= 32)) AS n_hex
FROM t
"""

PERSONAL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS emails,
    regexp_extract_all(text, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') AS ips,
    list_transform(regexp_extract_all(text, '[0-9]([\x20-]?[0-9])+'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS cards,
    list_transform(regexp_extract_all(text, '\+[0-9][\x20().0-9-]+[0-9]'), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g'))) AS phones
  FROM t
)
SELECT doc_id, len(emails) AS n_email,
  len(list_filter(ips, lambda x: list_max(list_transform(string_split(x, '.'), lambda p: p::DOUBLE)) <= 255)) AS n_ip,
  len(list_filter(cards, lambda x: length(x) BETWEEN 14 AND 19 AND list_sum(list_transform(range(length(x)),
    lambda i: CASE WHEN i % 2 = 0 THEN x[length(x) - i]::BIGINT
      ELSE 2 * x[length(x) - i]::BIGINT - CASE WHEN x[length(x) - i]::BIGINT > 4 THEN 9 ELSE 0 END END)) % 10 = 0)) AS n_card,
  len(list_filter(phones, lambda n: n BETWEEN 10 AND 15)) AS n_phone
FROM found
"""

EDITS = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
pairs AS (
  SELECT doc_id, text, length(text) // 2 AS half,
    coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next
  FROM t
)
SELECT doc_id, length(text) AS n_chars, sha256(substr(text, 1, length(text) - half) || substr(next, 1, half)) AS edited_sha256 FROM pairs
"""

QUALITY = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM t
),
windows AS (SELECT doc_id, i, words[i : i + 2] AS win FROM w, unnest(range(1, len(words) - 1)) AS u(i)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) >= 2),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(3) AS r(k) GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words, len(words) < 50 OR 100 * coalesce(n, 0) > 50 * len(words) AS base_failed
FROM w LEFT JOIN covered USING (doc_id)
"""

PLAIN_SQL: dict[str, str] = {
    "plain_mixing": MIXING,
    "plain_secrets": SECRETS,
    "plain_personal_data": PERSONAL,
    "plain_edits": EDITS,
    "plain_quality_counts": QUALITY,
}
