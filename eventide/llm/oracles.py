"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

from eventide.llm.reputation import ADDRESS, PUBLIC_SUFFIXES

_LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LOW}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS t
        FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(k) WHERE len(w) > 0),
here AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS t
         FROM d, (SELECT DISTINCT n FROM win) AS l, unnest(range(1, len(w) - n + 2)) AS u(k)),
hit AS (SELECT doc_id, k, n, item_id FROM here JOIN win USING (n, t)),
pos AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) FROM hit) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)"""

BACKOFF = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS c
      FROM d, unnest(range(1, len(w) + 1)) AS u(i)),
c1 AS (SELECT a, count(*) AS n1 FROM p GROUP BY a),
c2 AS (SELECT b, a, count(*) AS n2 FROM p WHERE b IS NOT NULL GROUP BY b, a),
c3 AS (SELECT c, b, a, count(*) AS n3 FROM p WHERE c IS NOT NULL GROUP BY c, b, a),
s AS (SELECT p.doc_id,
        CASE WHEN n3 >= 2 THEN log10(n3) - log10(h2.n2)
             WHEN c2.n2 >= 2 THEN log10(c2.n2) - log10(h1.n1)
             ELSE log10(c1.n1) - log10((SELECT count(*) FROM p)) END AS v,
        CASE WHEN p.b IS NULL OR n3 >= 2 THEN 0
             WHEN c2.n2 >= 2 THEN CASE WHEN p.c IS NULL THEN 0 ELSE 1 END
             ELSE CASE WHEN p.c IS NULL THEN 1 ELSE 2 END END AS steps
      FROM p JOIN c1 ON c1.a = p.a LEFT JOIN c2 ON c2.b = p.b AND c2.a = p.a
        LEFT JOIN c3 ON c3.c = p.c AND c3.b = p.b AND c3.a = p.a
        LEFT JOIN c2 h2 ON h2.b = p.c AND h2.a = p.b LEFT JOIN c1 h1 ON h1.a = p.b)
SELECT doc_id, len(w) AS n_words, round(coalesce(t, 0), 3) AS score, CAST(coalesce(k, 0) AS BIGINT) AS backoffs
FROM d LEFT JOIN (SELECT doc_id, sum(v + steps * log10(0.4)) AS t, sum(steps) AS k FROM s GROUP BY doc_id)
     USING (doc_id)"""


LINES = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, i, lines[i] AS line,
             translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), {_LOW}) AS key
      FROM d, unnest(range(1, len(lines) + 1)) AS u(i)),
first AS (SELECT key, min(doc_id) AS holder FROM l WHERE length(key) >= 10 GROUP BY key),
k AS (SELECT l.*, holder IS NOT NULL AND doc_id > holder AS gone FROM l LEFT JOIN first USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM k GROUP BY doc_id"""

COLLOCATIONS = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOW}), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
q AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
      FROM q, (VALUES (1), (2), (3)) AS s(m), unnest(range(1, len(w) - m + 2)) AS u(i)),
c AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
tot AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM c WHERE m > 1 AND f >= 10),
cut AS (SELECT x.lang, x.m, x.phrase, x.a, k, l.f AS l, r.f AS r,
               (1000000::HUGEINT * x.a * x.a // (l.f::HUGEINT * r.f))::BIGINT AS score
        FROM cand x, unnest(range(1, x.m)) AS u(k), c l, c r
        WHERE l.lang = x.lang AND l.phrase = array_to_string(x.w[1:k], ' ')
          AND r.lang = x.lang AND r.phrase = array_to_string(x.w[k + 1:x.m], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (SELECT lang, phrase, max(a) AS top
           FROM (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
                 FROM cand WHERE m = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN around USING (lang, phrase) WHERE top IS NULL OR 100 * top < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN tot USING (lang) WHERE rank <= 2000"""

INFILL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
             regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
           FROM documents),
u AS (SELECT doc_id, t, w, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
                  THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(list_slice(w, 1, a), '') AS pre, array_to_string(list_slice(w, a + 1, b), '') AS mid,
             array_to_string(list_slice(w, b + 1, n), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p"""


def url_reputation(rules: list[tuple[str, str, str]], limit: float = 0.5, z: float = 1.645,
                   public_suffixes: tuple[str, ...] = PUBLIC_SUFFIXES) -> str:
    two = ", ".join(f"'{x}'" for x in public_suffixes)
    table = ", ".join(f"('{h}', '{p}', '{h}{p}', '{v}')" for h, p, v in rules)

    def level(key: str, parent: str) -> str:
        """Posterior mean and size of a level; ``prior`` has the parent's mean."""
        return f"""
  SELECT {key}, (m * st + bad) / (st + n) AS mean, st + n AS size FROM
    (SELECT *, 1 / greatest(0.01, least(0.99, CASE WHEN full_ - noise = 0 THEN 0.5
                                                   ELSE (ss - noise) / (full_ - noise) END)) - 1 AS st
     FROM (SELECT *, sum(n * pow(bad / n - m, 2)) OVER () AS ss, sum(m * (1 - m)) OVER () AS noise,
                  sum(n * m * (1 - m)) OVER () AS full_
           FROM (SELECT x.*, prior.mean AS m FROM ({{stats}}) x JOIN ({{prior}}) prior USING ({parent}))))"""

    return rf"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
             regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g') AS body
           FROM pages),
v AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_LOW}) AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
             list_filter(regexp_split_to_array(body, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM u),
rules(rh, rp, rule, rv) AS (VALUES {table}),
r AS (SELECT v.*, m.rule, m.rv,
             CASE WHEN len(w) >= 20 THEN CAST(len(list_filter(w, lambda x: regexp_matches(x, '!!|[*$%#&]{{3}}'))) * 5 > len(w)
                                              OR len(list_distinct(w)) * 10 < len(w) * 3 AS INT) END AS bad
      FROM v LEFT JOIN LATERAL (SELECT rule, rv FROM rules
        WHERE (v.host = rh OR ends_with(v.host, '.' || rh)) AND starts_with(v.path, rp)
        ORDER BY length(rule) DESC, length(rh) DESC, rule LIMIT 1) m ON true),
names AS (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name
          FROM (SELECT DISTINCT host FROM v)),
cut AS (SELECT host, name, regexp_matches(name, '^([0-9]{{1,3}}\.){{3}}[0-9]{{1,3}}$|^\[') AS address,
               string_split(name, '.') AS p,
               CASE WHEN array_to_string(string_split(name, '.')[-2:], '.') IN ({two}) THEN 1 ELSE 0 END AS more FROM names),
parts AS (SELECT host, CASE WHEN address THEN name ELSE array_to_string(p[-2 - more:], '.') END AS domain,
                 CASE WHEN address THEN '{ADDRESS}' ELSE array_to_string(p[-1 - more:], '.') END AS suffix FROM cut),
hosts AS (SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad
          FROM r JOIN parts USING (host) WHERE bad IS NOT NULL GROUP BY ALL),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, 1 AS one, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
top AS (SELECT 1 AS one, sum(bad) / sum(n) AS mean FROM suffixes),
ps AS ({level('suffix', 'one').format(stats='SELECT * FROM suffixes', prior='SELECT * FROM top')}),
pd AS ({level('domain', 'suffix').format(stats='SELECT * FROM domains', prior='SELECT * FROM ps')}),
ph AS ({level('host', 'domain').format(stats='SELECT * FROM hosts', prior='SELECT * FROM pd')}),
rated AS (SELECT r.*, coalesce(ph.mean, pd.mean, ps.mean, (SELECT mean FROM top), 0) AS m,
                 coalesce(ph.size, pd.size, ps.size, 0) AS size
          FROM r JOIN parts ON parts.host = r.host LEFT JOIN ph ON ph.host = r.host
            LEFT JOIN pd ON pd.domain = parts.domain LEFT JOIN ps ON ps.suffix = parts.suffix)
SELECT page_id, host, path, rule,
       coalesce(rv, CASE WHEN m - {z} * sqrt(m * (1 - m) / (size + 1)) > {limit} THEN 'block' ELSE 'allow' END) AS verdict
FROM rated"""
