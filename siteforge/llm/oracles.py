"""DuckDB SQL of the operators that SQL can express."""
from siteforge.llm import contamination, quality, urls

_WORD, _GAP = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def line_quality() -> str:
    stock = " OR ".join(f"contains(lower(line), '{p}')" for p in quality.BOILERPLATE)
    marks, n = quality.SEPARATORS, _count("line", _WORD)
    bad = (
        f"({stock} OR ({_count('line', marks)} > 0 AND {_count('line', marks)} * 4 >= {_count('line', _GAP + '+')} + 1) "
        f"OR ({n} BETWEEN 6 AND 40 AND len(list_distinct(regexp_extract_all(line, '{_WORD}'))) * 2 <= {n}) "
        f"OR ({n} < 10 AND NOT regexp_matches(line, '{quality.END_MARK}')) "
        f"OR (length(line) >= 20 AND ({_count('line', quality.SYMBOLS)} * 10 > length(line) OR {_count('line', quality.NOT_TEXT)} * 10 > 3 * length(line))))"
    )
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT rid, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
win AS (SELECT rid, i, list_slice(ws, i, i + 4) AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, range(0, 5) AS r(k) GROUP BY rid),
l AS (SELECT rid, line FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}')),
ls AS (SELECT rid, count(*) - count(DISTINCT line) AS dup, coalesce(sum({_count('line', _WORD)}) FILTER (WHERE {bad}), 0) AS lost FROM l GROUP BY rid),
c AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  {_count('t', quality.SYMBOLS)}::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_words
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN ls USING (rid)),
f AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND lost_words <= {quality.MAX_LOST} * n_words AS kept FROM f"""


def decontamination() -> str:
    span, window, masks = contamination.SPAN, contamination.WINDOW, contamination.MASKS

    def seeds(table: str, at: str) -> str:
        keys = ", ".join("concat_ws(' ', " + ", ".join([f"'{k}'", *[f"h[{at} + {x + 1}]" for x, c in enumerate(m) if c == "1"]]) + ")" for k, m in enumerate(masks))
        return f"SELECT rid, {at}, unnest([{keys}]) AS seed FROM (SELECT rid, h, unnest(range(0, len(h) - {span - 1})) AS {at} FROM {table})"

    same = "list_sum(list_transform(range(0, width), lambda x: CASE WHEN i - j + k + x >= 0 AND dh[i - j + k + x + 1] = ih[k + x + 1] THEN 1 ELSE 0 END))"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS h FROM documents),
b AS MATERIALIZED (SELECT row_number() OVER () AS rid, item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS h FROM benchmark),
ds AS ({seeds('d', 'i')}),
bs AS ({seeds('b', 'j')}),
hits AS (SELECT d.doc_id, b.item_id, i, j, d.h AS dh, b.h AS ih, least({window}, len(b.h)) AS width
  FROM ds JOIN bs USING (seed) JOIN d ON ds.rid = d.rid JOIN b ON bs.rid = b.rid),
scored AS (SELECT doc_id, item_id, list_max(list_transform(range(greatest(0, j + {span} - width), least(j, len(ih) - width) + 1), lambda k: {same}))::DOUBLE / width AS a FROM hits)
SELECT doc_id, item_id, count(*) FILTER (WHERE a >= {contamination.SIMILARITY}::DOUBLE) AS n_hits, round(max(a), 6) AS agreement
FROM scored GROUP BY doc_id, item_id HAVING max(a) >= {contamination.SIMILARITY}::DOUBLE"""


def url_filter() -> str:
    low = lambda c: f"translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    whens = {"rule": [], "by_rule": []}
    for text, what in sorted(urls.RULES, key=lambda r: -len(r[0])):
        domain, _, rest = text.partition("/")
        fits = f"WHEN (host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '/{rest}') THEN"
        whens["rule"].append(f"{fits} '{text}'")
        whens["by_rule"].append(f"{fits} '{what}'")
    link = r"(?i)(?:href|src)[\s\x0B]*=[\s\x0B]*[\x22\x27]?((?:[a-z][a-z0-9+.-]*:)?//[^\s\x0B\x22\x27>]+)"
    rounds = "".join(
        f"r{n + 1} AS MATERIALIZED (SELECT kind, host, sum(m) AS rank FROM (SELECT r.kind, s.dst AS host, {urls.DAMPING}::DOUBLE * r.rank * s.share AS m FROM r{n} r JOIN shares s ON r.kind = s.kind AND r.host = s.src "
        f"UNION ALL SELECT kind, host, (1 - {urls.DAMPING}::DOUBLE) * seed FROM seeds) GROUP BY kind, host),\n"
        for n in range(urls.ROUNDS)
    )
    return f"""
WITH u AS (SELECT page_id, html, {low(f"coalesce(regexp_extract(url, '{urls._URL}', 1), '')")} AS host, coalesce(regexp_extract(url, '{urls._URL}', 2), '') AS path FROM pages),
p AS MATERIALIZED (SELECT *, CASE {' '.join(whens['rule'])} END AS rule, CASE {' '.join(whens['by_rule'])} END AS by_rule FROM u),
links AS (SELECT host AS src, {low("regexp_extract(link, '//([^/?#]*)', 1)")} AS dst FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM p)),
edges AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM links WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
sides AS (SELECT 'allow' AS kind, src, dst, n FROM edges UNION ALL SELECT 'block', dst, src, n FROM edges),
shares AS MATERIALIZED (SELECT kind, src, dst, n::DOUBLE / sum(n) OVER (PARTITION BY kind, src) AS share FROM sides),
s AS (SELECT by_rule AS kind, host, count(*) AS n FROM p WHERE by_rule IS NOT NULL AND host <> '' GROUP BY by_rule, host),
seeds AS MATERIALIZED (SELECT kind, host, n::DOUBLE / sum(n) OVER (PARTITION BY kind) AS seed FROM s),
r0 AS (SELECT kind, host, seed AS rank FROM seeds),
{rounds}hosts AS (SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'allow'), 0) AS trust, coalesce(sum(rank) FILTER (WHERE kind = 'block'), 0) AS distrust
  FROM (FROM r{urls.ROUNDS} UNION ALL SELECT kind, host, -(1 - {urls.DAMPING}::DOUBLE) * seed FROM seeds WHERE kind = 'block') GROUP BY host),
lim AS (SELECT {urls.THRESHOLD}::DOUBLE * (1 - {urls.DAMPING}::DOUBLE) / count(*) AS least FROM seeds WHERE kind = 'block')
SELECT page_id, p.host, path, rule, coalesce(by_rule, CASE WHEN distrust >= least AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict,
  round(coalesce(trust, 0), 12) AS trust, round(coalesce(distrust, 0), 12) + 0.0 AS distrust FROM p LEFT JOIN hosts USING (host) CROSS JOIN lim"""


ORACLES: dict[str, str] = {"op3_line_quality": line_quality(), "op7_decontamination": decontamination(), "op10_url_filter": url_filter()}
