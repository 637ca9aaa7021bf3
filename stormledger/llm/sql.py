"""DuckDB SQL that gives the rows of the queries that SQL can express."""

from __future__ import annotations

import re

from stormledger.llm.chat import CONTROLS, MARKS
from stormledger.llm.licenses import _MARK, PHRASES, TEMPLATES

_LETTERS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

ORACLES: dict[str, str] = {}


def _template_sql(template: str) -> str:
    """The markup as a regular expression over words that each have a space before them."""
    out = ""
    for mark in _MARK.findall(template):
        if mark == "[[":
            out += "(?:"
        elif mark == "]]":
            out += ")?"
        elif mark[0] == "{":
            low, high = mark.strip("{}").split("-")
            out += f"(?: [^ ]+){{{low},{high}}}"
        else:
            out += " " + mark
    return f"{out} "


_LABELS = ", ".join(
    [f"CASE WHEN contains(j, ' {p} ') THEN '{label}' END" for p, label in PHRASES.items()]
)
_FOUND = ", ".join(
    "CASE WHEN "
    + " OR ".join(f"regexp_matches(j, '{_template_sql(t)}')" for t in texts)
    + f" THEN '{label}' END"
    for label, texts in TEMPLATES.items()
)
_PHRASE_ROWS = ", ".join(f"('{p}', {len(p.split())})" for p in PHRASES)
_ALL_LABELS = "list_concat(base, found)"

ORACLES["op3_license_scans"] = f"""
WITH d AS (SELECT doc_id, {_LETTERS} AS w FROM documents),
j AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS j FROM d),
phrases(p, k) AS (VALUES {_PHRASE_ROWS}),
places AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, p, array_to_string(w[i + 1 : i + k], ' ') AS g, i
    FROM (SELECT doc_id, w, p, k, unnest(range(0, len(w) - k + 1)) AS i
      FROM j, phrases WHERE contains(j, ' ' || p || ' ') AND len(w) >= k)
  ) WHERE g = p
),
base AS (SELECT doc_id, count(*) AS n, min(i) AS low, max(i) AS high FROM places GROUP BY doc_id),
labelled AS (
  SELECT doc_id, len(w) AS n_words,
    list_filter([{_LABELS}], lambda x: x IS NOT NULL) AS base,
    list_filter([{_FOUND}], lambda x: x IS NOT NULL) AS found
  FROM j
)
SELECT doc_id, n_words, coalesce(n, 0) AS n_base, low AS first_word, high AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels,
  array_to_string(list_sort(list_distinct({_ALL_LABELS})), ',') AS labels,
  CASE WHEN len(found) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END AS score
FROM labelled LEFT JOIN base USING (doc_id)
"""

_ESCAPED = "|".join(re.escape(c) for c in ["\\", *CONTROLS])
_FRAME = sum(len(m) for m in MARKS.values())


def _longer(column: str) -> str:
    """Length of the escaped text: one character more for each backslash or control string."""
    return f"length(regexp_replace({column}, '({_ESCAPED})', 'x\\1', 'g'))"


ORACLES["op7_chat_formatting"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum({_FRAME} + {_longer("role")} + {_longer("text")})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

ORACLES["op6_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_LETTERS} AS w FROM documents),
b AS (SELECT item_id, {_LETTERS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
lens AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (
    SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM d, lens WHERE len(w) >= m
  )
),
hit AS (SELECT doc_id, i, dw.m, item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hit))
  GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: Ratio -> least room above the upper quartile, as in quality_rules.RATIOS.
_ROOM = {
    "symbol_ratio": 0.05,
    "capital_ratio": 0.25,
    "dup_line_ratio": 0.40,
    "repeat_ratio": 0.35,
    "word_length": 6.0,
}


def _limit_sql(name: str, keys: str) -> str:
    by = f"{keys}, ratio" if keys else "ratio"
    return f"""
{name}_bins AS (SELECT {by}, bin, sum(n) AS n FROM bins GROUP BY {by}, bin),
{name}_seen AS (
  SELECT {by}, bin, sum(n) OVER (PARTITION BY {by} ORDER BY bin) AS seen,
    sum(n) OVER (PARTITION BY {by}) AS total FROM {name}_bins
),
{name}_limit AS (
  SELECT {by}, total, high + greatest(3.0 * (high - low), room) AS cut FROM (
    SELECT {by}, total,
      min(edge) FILTER (WHERE seen >= total * 0.25) AS low,
      min(edge) FILTER (WHERE seen >= total * 0.75) AS high
    FROM (SELECT *, CASE WHEN bin = 0 THEN 0.0 ELSE 1e-4 * pow(1.05, bin) END AS edge FROM {name}_seen)
    GROUP BY {by}, total
  ) JOIN rooms USING (ratio)
)"""


_WIDE = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, '{r}' AS ratio, {r}::DOUBLE AS v FROM q" for r in _ROOM
)
_ROOMS = ", ".join(f"('{r}', {v})" for r, v in _ROOM.items())

ORACLES["op9_quality_rules"] = f"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, {_SPACED} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
),
twice AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 3)) AS p FROM win JOIN twice USING (doc_id, g)
  ) GROUP BY doc_id
),
c AS (
  SELECT d.doc_id, lang, source, len(w) AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
    coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)
),
q AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbol_ratio,
    CASE WHEN word_chars > 0 THEN n_capitals / word_chars ELSE 0 END AS capital_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_ratio,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS word_length
  FROM c
),
wide AS ({_WIDE}),
rooms(ratio, room) AS (VALUES {_ROOMS}),
bins AS (
  SELECT lang, source, ratio,
    CASE WHEN v <= 1e-4 THEN 0 ELSE ceil(ln(v / 1e-4) / ln(1.05))::INT END AS bin, count(*) AS n
  FROM wide GROUP BY ALL
),
{_limit_sql("own", "lang, source")},
{_limit_sql("tongue", "lang")},
{_limit_sql("every", "")},
beyond AS (
  SELECT doc_id, bool_or(v > CASE WHEN own_limit.total >= 200 THEN own_limit.cut
    WHEN tongue_limit.total >= 200 THEN tongue_limit.cut ELSE every_limit.cut END) AS out
  FROM wide
  LEFT JOIN own_limit ON own_limit.lang IS NOT DISTINCT FROM wide.lang
    AND own_limit.source IS NOT DISTINCT FROM wide.source AND own_limit.ratio = wide.ratio
  LEFT JOIN tongue_limit ON tongue_limit.lang IS NOT DISTINCT FROM wide.lang
    AND tongue_limit.ratio = wide.ratio
  LEFT JOIN every_limit ON every_limit.ratio = wide.ratio
  GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT out AS kept
FROM q JOIN beyond USING (doc_id)
"""

ORACLES["op10_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
first AS (SELECT g, min(doc_id) AS doc_id FROM win GROUP BY g HAVING count(DISTINCT doc_id) > 1),
gone AS (
  SELECT DISTINCT win.doc_id, unnest(range(i, i + 50)) AS p
  FROM win JOIN first USING (g) WHERE win.doc_id > first.doc_id
),
words AS (SELECT doc_id, w[p] AS x, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES["op5_ngram_jaccard"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED.replace("coalesce(text, '')", _LOWERED)} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
),
link AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 90 * (p.n + q.n - k)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
)
SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other) AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id
"""

#: The checksum of a feature, a byte at a time over the table of the polynomial.
_BYTES = "list_transform(range(0, octet_length(encode(g))), lambda i: ('0x' || substr(hex(encode(g)), 2 * i::INT + 1, 2))::BIGINT)"

ORACLES["op13_importance_resampling"] = f"""
WITH RECURSIVE crc(i, k, c) AS (
  SELECT i, 0, i FROM range(0, 256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
),
lookup AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
d AS (SELECT doc_id, {_LETTERS} AS w FROM documents),
b AS (SELECT {_LETTERS} AS w FROM benchmark),
runs AS (
  SELECT doc_id, true AS raw, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM d
  UNION ALL
  SELECT NULL, false, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) FROM b
),
hashed AS (
  SELECT g, xor(list_reduce({_BYTES}, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM runs), lookup
),
f AS (SELECT doc_id, raw, bucket FROM runs JOIN hashed USING (g)),
n AS (SELECT bucket, (count(*) FILTER (WHERE raw))::DOUBLE AS s, (count(*) FILTER (WHERE NOT raw))::DOUBLE AS t FROM f GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (big_s + 10000)) / ((s + 1) * (big_t + 10000))))::BIGINT AS gain
  FROM n, (SELECT sum(s) AS big_s, sum(t) AS big_t FROM n)
),
mean AS (SELECT doc_id, sum(gain)::BIGINT AS total, count(*) AS k FROM f JOIN gain USING (bucket) WHERE raw GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(k, 0) AS n_features,
    CASE WHEN k IS NULL THEN 0 ELSE (total - ((total % k) + k) % k) // k END AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS gumbel
  FROM d LEFT JOIN mean USING (doc_id)
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY weight + gumbel DESC, doc_id) AS r, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight::BIGINT AS weight, (weight + gumbel)::BIGINT AS score,
  CASE WHEN r <= 25 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

ORACLES["op12_phrase_collocations"] = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    regexp_extract_all(unnest(string_split_regex({_LOWERED}, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
  FROM documents
),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
f AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (
    SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM pieces, range(1, 5) t(m) WHERE len(w) >= m
  ) GROUP BY ALL HAVING count(*) >= 30
),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
cuts AS (
  SELECT lang, phrase, m, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : m], ' ') AS tail
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c)
),
best AS (
  SELECT cuts.lang, cuts.phrase, cuts.m, a, x.f AS l, y.f AS r, (2000000 * a::HUGEINT // (x.f + y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1
),
held AS (
  SELECT DISTINCT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, a AS longer
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c))
),
kept AS (
  SELECT * FROM best WHERE NOT EXISTS (
    SELECT 1 FROM held WHERE held.lang = best.lang AND held.phrase = best.phrase AND 100 * longer >= 80 * a
  )
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000
"""
