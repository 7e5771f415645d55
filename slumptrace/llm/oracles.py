"""SQL for DuckDB that gives the rows of those queries that SQL can express, by plain comparison of everything."""

from __future__ import annotations

from slumptrace.llm.aliases import RULES
from slumptrace.llm.decontam import LEAST, SHORTEST, WINDOW
from slumptrace.llm.licenses import TEMPLATES, THRESHOLD

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _plain_words(text: str) -> str:
    return rf"list_filter(string_split(regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')"


# Components of edges (a, b) by passing the smallest name on until nothing changes.
_REACH = """
    ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT a AS node, a AS root FROM ends UNION SELECT e.b, r.root FROM reach r JOIN ends e ON r.node = e.a),
    components AS (SELECT node, min(root) AS component FROM reach GROUP BY node)"""

OP4 = f"""
WITH ours AS (SELECT doc_id, {_plain_words("coalesce(text, '')")} AS words FROM documents),
theirs AS (SELECT DISTINCT item_id, {_plain_words("text")} AS words FROM benchmark WHERE text IS NOT NULL),
d AS (SELECT doc_id, row_number() OVER () AS r, len(words) AS size, unnest(words) AS word, unnest(range(len(words))) AS at FROM ours),
i AS (SELECT item_id, len(words) AS n, words AS item, unnest(words) AS word, unnest(range(len(words))) AS at
      FROM theirs WHERE len(words) > 0),
hits AS (SELECT doc_id, r, size, item_id, n, item, d.at - i.at AS start, i.at AS k FROM d JOIN i ON d.word = i.word),
wide AS (SELECT *, count(*) OVER (PARTITION BY r, item_id, item, start ORDER BY k RANGE BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS near,
                count(*) OVER (PARTITION BY r, item_id, item, start) AS matched,
                least({WINDOW}, n) AS width
         FROM hits),
found AS (SELECT DISTINCT doc_id, item_id, n, matched, greatest(start, 0) AS position FROM wide
          WHERE CASE WHEN n < 9 THEN matched = n AND (n >= {SHORTEST} OR n = size)
                ELSE near >= ceil({LEAST}::DOUBLE / {WINDOW} * width) AND matched >= ceil({LEAST}::DOUBLE / {WINDOW} * width) END)
SELECT doc_id, item_id, CAST(arg_max(n, (matched, -position)) AS INTEGER) AS n_words, CAST(max(matched) AS INTEGER) AS matched,
       CAST(arg_max(position, (matched, -position)) AS INTEGER) AS position
FROM found GROUP BY doc_id, item_id"""

_HOST = _LOWER.format(r"regexp_extract(coalesce({0}, ''), '(?s)^.*?://([^/?#]*)', 1)")
_PATH = r"regexp_extract(coalesce({0}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _best_rule(value: int) -> str:
    cases = " ".join(
        f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{(verdict, host + path)[value]}'"
        for verdict, host, path in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    return f"CASE {cases} END"


OP5 = rf"""
WITH RECURSIVE raw AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
tags AS (SELECT url, unnest([
    regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*[\"'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*[\"'']?([^\"''\s>]+)', 1),
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*[\"'']?([^\"''\s>]+)', 1)
  ]) AS target FROM raw),
declared AS (SELECT url AS a, CASE WHEN starts_with(target, '/') AND NOT starts_with(target, '//')
                                   THEN regexp_extract(url, '(?s)^.*?://[^/?#]*') || target ELSE target END AS b
             FROM tags WHERE contains(url, '://')),
named AS (SELECT url FROM raw UNION SELECT b FROM declared WHERE b LIKE '%://%'),
forms AS (SELECT url, regexp_replace({_HOST.format("url")}, '^(www|m)\.', '')
                 || regexp_replace({_PATH.format("url")}, '(/index)?\.html?$|/+$', '')
                 || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_sort(kept), '&') ELSE '' END AS form
          FROM (SELECT url, list_filter(string_split(regexp_extract(url, '(?s)^[^#]*?\?([^#]*)', 1), '&'),
                                        lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_\w+|ref|fbclid|gclid)=')) AS kept
                FROM named WHERE url LIKE '%://%')),
links AS (SELECT DISTINCT a, b FROM (SELECT a, b FROM declared WHERE b LIKE '%://%' UNION SELECT url, form FROM forms) WHERE a <> b),
{_REACH},
judged AS (SELECT *, {_best_rule(1)} AS rule, {_best_rule(0)} AS own
           FROM (SELECT DISTINCT u, {_HOST.format("u")} AS host, {_PATH.format("u")} AS path
                 FROM (SELECT url AS u FROM raw UNION SELECT a FROM links UNION SELECT b FROM links))),
given AS (SELECT component, CASE WHEN bool_or(own = 'allow') THEN 'allow' ELSE 'block' END AS verdict
          FROM components JOIN judged ON node = u WHERE own IS NOT NULL GROUP BY component)
SELECT page_id, host, path, rule, coalesce(own, g.verdict, 'allow') AS verdict
FROM raw JOIN judged ON url = u LEFT JOIN components ON node = url AND contains(url, '://') LEFT JOIN given g USING (component)"""

OP6 = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, row_number() OVER () AS r,
           list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
shingled AS (SELECT doc_id, r, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
                            ELSE list_distinct([w[k:k + 3] FOR k IN range(1, len(w) - 2)]) END AS s FROM split),
laid AS (SELECT r, len(s) AS n, unnest(s) AS shingle FROM shingled),
matched AS (SELECT a.r AS a, b.r AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
         FROM laid a JOIN laid b ON a.shingle = b.shingle AND a.r < b.r GROUP BY a.r, b.r),
links AS (SELECT a, b FROM matched WHERE 100 * common >= 85 * (na + nb - common)),
{_REACH},
placed AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component, r) AS root FROM shingled LEFT JOIN components ON node = r)
SELECT doc_id, n_shingles, min(doc_id) OVER (PARTITION BY root) AS component_id FROM placed"""

_KNOWN = ", ".join(f"({_quoted(a)}, {_quoted(b)}, {_quoted(t)})" for (a, b), t in TEMPLATES.items())
_PAIRS = "[[w[k], w[k + 1]] FOR k IN range(1, len(w))]"

OP8 = f"""
WITH known AS (SELECT licence, template, {_plain_words("text")} AS w FROM (VALUES {_KNOWN}) v(licence, template, text)),
grams AS (SELECT licence, template, n AS theirs, gram, count(*) AS there
          FROM (SELECT licence, template, len(w) - 1 AS n, unnest({_PAIRS}) AS gram FROM known WHERE len(w) > 1) GROUP BY ALL),
raw AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
               regexp_split_to_array(coalesce(text, ''), '\\n[\\x20\\t]*\\n') AS paragraphs FROM documents),
units AS (SELECT doc_id, r, row_number() OVER () AS unit, unit_kind, {_plain_words("u")} AS w
          FROM (SELECT doc_id, r, 'line' AS unit_kind, unnest(string_split(text, chr(10))) AS u FROM raw
                UNION ALL SELECT doc_id, r, 'paragraph', unnest(list_filter(paragraphs, lambda p: contains(trim(p), chr(10)))) FROM raw
                UNION ALL SELECT doc_id, r, 'text', text FROM raw WHERE len(paragraphs) > 1)),
ours AS (SELECT doc_id, unit, unit_kind, n AS ours, gram, count(*) AS here
         FROM (SELECT doc_id, unit, unit_kind, len(w) - 1 AS n, unnest({_PAIRS}) AS gram FROM units WHERE len(w) > 1) GROUP BY ALL),
dice AS (SELECT doc_id, unit, unit_kind, licence, template, 2.0::DOUBLE * sum(least(here, there)) / (ours + theirs) AS dice
         FROM ours JOIN grams USING (gram) GROUP BY doc_id, unit, unit_kind, ours, licence, template, theirs)
SELECT doc_id, licence, template, unit_kind, count(*) AS n_units, max(dice) AS dice
FROM dice WHERE dice >= {THRESHOLD} GROUP BY doc_id, licence, template, unit_kind"""

OP10 = f"""
WITH RECURSIVE rows AS (SELECT vec_id, row_number() OVER () AS r, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings),
sound AS (SELECT r, v, sqrt(list_inner_product(v, v)) AS norm FROM rows
          WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.r < b.r AND len(a.v) = len(b.v)
          WHERE list_inner_product(a.v, b.v) / a.norm / b.norm >= 0.9),
{_REACH},
counted AS (SELECT r, count(*) AS n FROM (SELECT a AS r FROM links UNION ALL SELECT b FROM links) GROUP BY r),
placed AS (SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, r) AS root
           FROM rows LEFT JOIN counted USING (r) LEFT JOIN components ON node = r)
SELECT vec_id, n_links, component_id, vec_id IS NOT NULL AND vec_id = component_id AS kept
FROM (SELECT *, min(vec_id) OVER (PARTITION BY root) AS component_id FROM placed)"""

_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13 = f"""
WITH words AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
totals AS (SELECT count(*) AS n_all, sum(len(w))::BIGINT AS l_all FROM words WHERE len(w) > 0),
counts AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM words) GROUP BY r, term),
spread AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS.format(_LOWER.format("coalesce(text, '')"))}) AS term FROM benchmark),
weighed AS (SELECT asked.item_id, term, CAST(floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
            FROM asked JOIN spread USING (term), totals),
sizes AS (SELECT r, doc_id, 100 - 90 + ((90 * len(w) * n_all) // l_all) AS m FROM words, totals WHERE len(w) > 0),
scored AS (SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM weighed JOIN counts USING (term) JOIN sizes USING (r) GROUP BY item_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM scored JOIN sizes USING (r) WHERE score > 0) WHERE rank <= 10"""

ORACLES = {
    "op4_decontaminate": OP4, "op5_url_aliases": OP5, "op6_jaccard": OP6, "op8_licences": OP8, "op10_vectors": OP10,
    "op13_search": OP13,
}
