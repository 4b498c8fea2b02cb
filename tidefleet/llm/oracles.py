"""SQL for the text operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from tidefleet.llm import license_scan, line_dedup, url_filter
from tidefleet.llm.common import UPPER

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP6 = f"""WITH p AS (SELECT doc_id, coalesce(source, '') AS site, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
u AS (SELECT DISTINCT site, coalesce(text, '') AS text FROM p), total AS (SELECT site, count(*) AS pages FROM u GROUP BY 1),
l AS (SELECT DISTINCT site, text, trim(line) AS line FROM (SELECT site, text, unnest(string_split(text, chr(10))) AS line FROM u) WHERE trim(line) <> ''),
bad AS (SELECT l.site, line FROM l JOIN total ON l.site = total.site GROUP BY l.site, line, pages HAVING count(*) >= {line_dedup.MIN_PAGES} AND count(*) > CAST({line_dedup.RATIO} AS DOUBLE) * pages),
lists AS (SELECT site, list(line) AS bad FROM bad GROUP BY 1),
cut AS (SELECT p.*, list_filter(lines, lambda x: trim(x) = '' OR NOT list_contains(coalesce(bad, []), trim(x))) AS kept FROM p LEFT JOIN lists ON p.site = lists.site),
j AS (SELECT *, array_to_string(kept, chr(10)) AS shorter FROM cut),
t AS (SELECT *, text IS NOT NULL AND len(kept) < len(lines) AS taken FROM j)
SELECT doc_id, CAST(CASE WHEN taken THEN len(lines) - len(kept) ELSE 0 END AS BIGINT) AS n_dropped, CASE WHEN taken THEN shorter ELSE text END AS text FROM t"""

OP9 = f"""WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark), bm AS (SELECT *, least(len(w), 10) AS m FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, m, list_slice(w, i, i + m - 1) AS win FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM bm)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents), sizes AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, list_slice(w, i, i + m - 1) AS win FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
h AS (SELECT doc_id, dw.m, i, item FROM dw JOIN bw ON dw.m = bw.m AND dw.win = bw.win),
n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM h) GROUP BY 1),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN k ON d.doc_id = k.doc_id"""


def _level(name: str, keys: str, above: str) -> str:
    """Members of one level with the mean p that each inherits, and the level's strength s by the spread among members of several outcomes."""
    low, high, usual, weight = (f"CAST({x} AS DOUBLE)" for x in (url_filter.LEAST_STRENGTH, url_filter.MOST_STRENGTH, url_filter.USUAL_CORRELATION, url_filter.USUAL_WEIGHT))
    return f"""{name}_m AS ({above}),
{name}_r AS (SELECT (coalesce(sum(pow(good - n * p, 2) / (n * p * (1 - p)) - 1), 0) + {weight} * {usual}) / (coalesce(sum(n - 1), 0) + {weight}) AS rho FROM {name}_m WHERE n > 1),
{name}_s AS (SELECT CASE WHEN rho > 0 THEN least({high}, greatest({low}, 1 / rho - 1)) ELSE {high} END AS s FROM {name}_r),
{name}_p AS (SELECT {keys}, p, n, good, s FROM {name}_m, {name}_s)"""


_RULES = " ".join(
    f"WHEN (host = '{r.partition('/')[0]}' OR host LIKE '%.{r.partition('/')[0]}') AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'" for _, r in sorted(url_filter.RULES, key=lambda x: (-len(x[1]), -x[1].index("/")))
)
_VERDICTS = " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in url_filter.RULES)
_SUM = "CAST(sum(n) AS DOUBLE) AS n, CAST(sum(good) AS DOUBLE) AS good"
_LONG = ", ".join(f"'{x}'" for x in url_filter.LONG_SUFFIXES)

OP8 = f"""WITH r AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
y AS (SELECT doc_id AS page_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
h0 AS (SELECT host, count(y.good) AS n, coalesce(sum(y.good), 0) AS good FROM q LEFT JOIN y ON q.page_id = y.page_id GROUP BY 1),
h1 AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM h0),
h2 AS (SELECT *, string_split(bare, '.') AS parts, regexp_matches(bare, '^[0-9.]*$|^\\[') AS address FROM h1),
h3 AS (SELECT *, array_to_string(parts[greatest(len(parts) - 1, 1):], '.') AS last2, array_to_string(parts[greatest(len(parts) - 2, 1):], '.') AS last3 FROM h2),
h4 AS (SELECT host, n, good, CASE WHEN address THEN bare WHEN last2 IN ({_LONG}) THEN last3 ELSE last2 END AS domain, address FROM h3),
h AS (SELECT host, n, good, domain, CASE WHEN address THEN '' ELSE regexp_replace(domain, '^[^.]*\\.?', '') END AS suffix FROM h4),
{_level("suffix", "suffix", f"SELECT suffix, n, good, (tg - good + 1) / (tn - n + 2) AS p FROM (SELECT suffix, {_SUM} FROM h GROUP BY 1), (SELECT CAST(sum(good) AS DOUBLE) AS tg, CAST(sum(n) AS DOUBLE) AS tn FROM h)")},
{_level("domain", "suffix, domain", f"SELECT x.*, (u.s * u.p + u.good - x.good) / (u.s + u.n - x.n) AS p FROM (SELECT suffix, domain, {_SUM} FROM h GROUP BY 1, 2) x JOIN suffix_p u ON x.suffix = u.suffix")},
{_level("host", "host", f"SELECT x.*, (u.s * u.p + u.good - x.good) / (u.s + u.n - x.n) AS p FROM (SELECT suffix, domain, host, {_SUM} FROM h GROUP BY 1, 2, 3) x JOIN domain_p u ON x.suffix = u.suffix AND x.domain = u.domain")},
ab AS (SELECT host, s * p + good AS a, s * (1 - p) + n - good AS b FROM host_p),
v AS (SELECT host, a / (a + b) AS posterior, greatest(0, least(1, a / (a + b) + CAST({url_filter.Z} AS DOUBLE) * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))))) AS bound FROM ab),
w AS (SELECT q.page_id, q.host, q.path, CASE {_RULES} END AS rule, posterior, bound FROM (SELECT * FROM q) q JOIN v ON q.host = v.host)
SELECT page_id, host, path, rule, CASE rule {_VERDICTS} ELSE CASE WHEN bound < {url_filter.MIN_GOOD} THEN 'block' ELSE 'allow' END END AS verdict, round(posterior, 6) AS posterior, round(bound, 6) AS bound FROM w"""
OP8 = OP8.replace("(host = '", "(q.host = '").replace(" OR host LIKE", " OR q.host LIKE")

OP13 = rf"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
l AS (SELECT doc_id, min(quality) AS quality, min(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
m AS (SELECT t, min(doc_id) AS first FROM d GROUP BY 1),
f AS (SELECT part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b, 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 5 * length(d.t) AS c, regexp_matches(d.t, '[#$%&*|]') AS dd, coalesce(d.doc_id > first, false) AS e,
  coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad FROM d JOIN m ON d.t = m.t LEFT JOIN l ON d.doc_id = l.doc_id),
x AS (SELECT *, CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(dd AS INT) + CAST(e AS INT) AS n_fails, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN dd THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed FROM f),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT k1.k || k2.k || k3.k || k4.k || k5.k AS filter_order FROM k k1, k k2, k k3, k k4, k k5 WHERE len(list_distinct([k1.k, k2.k, k3.k, k4.k, k5.k])) = 5),
r AS (SELECT part, filter_order, n_fails, failed, good, bad, coalesce(list_min(list_transform(string_split(failed, ''), lambda z: CASE WHEN z = '' THEN 6 ELSE strpos(filter_order, z) END)), 6) AS first FROM x, o),
s AS (SELECT r.*, step, substr(filter_order, step, 1) AS letter, strpos(failed, substr(filter_order, step, 1)) > 0 AS here FROM r, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step) steps),
g AS (SELECT part, filter_order, step, letter, count_if(first > step) AS kept, count_if(first = step) AS removed, count_if(here AND first < step) AS redundant, count_if(here AND n_fails = 1) AS unique_fails, count_if(first = step AND good) AS good_lost, count_if(first = step AND bad) AS toxic_lost FROM s GROUP BY ALL)
SELECT part, filter_order, step, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))}, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM g"""

#: crc32 byte by byte: its table of 256 entries from the polynomial, then a fold over a feature's bytes in hexadecimal.
_CRC = """crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([CAST(i AS BIGINT)], [CAST(0 AS BIGINT) for z in range(8)]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
hexed AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM features)),
bytes AS (SELECT feature, list_transform(range(1, length(h), 2), lambda i: CAST(16 * (strpos('0123456789ABCDEF', h[i]) - 1) + strpos('0123456789ABCDEF', h[i + 1]) - 1 AS BIGINT)) AS b FROM hexed),
hashed AS (SELECT feature, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc)"""

OP12 = f"""WITH texts AS (SELECT 'd' AS side, row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents UNION ALL SELECT 'b', row_number() OVER (), NULL, {_WORDS} FROM benchmark),
features AS (SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM texts),
{_CRC},
each AS (SELECT side, r, bucket, count(*) AS n FROM features JOIN hashed ON features.feature = hashed.feature GROUP BY ALL),
counts AS (SELECT bucket, CAST(sum(CASE WHEN side = 'd' THEN n ELSE 0 END) AS DOUBLE) AS s, CAST(sum(CASE WHEN side = 'b' THEN n ELSE 0 END) AS DOUBLE) AS t FROM each GROUP BY 1),
totals AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM counts),
gains AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000)))) AS BIGINT) AS gain FROM counts, totals),
weights AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight FROM each JOIN gains ON each.bucket = gains.bucket WHERE side = 'd' GROUP BY 1),
h AS (SELECT r, doc_id, len(w) AS n_words, list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform(range(1, 9), lambda i: CAST(strpos('0123456789abcdef', sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[i]) - 1 AS BIGINT))), lambda c, x: 16 * c + x) AS h FROM texts WHERE side = 'd'),
scored AS (SELECT h.r, doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM h LEFT JOIN weights ON h.r = weights.r),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS rank FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 25 * count(*) // 100 FROM placed) THEN rank END AS rank FROM scored LEFT JOIN placed ON scored.r = placed.r"""

_TEMPLATES = ", ".join(f"({k}, '{t.label}', {t.phrase}, '{t.text}', {t.drift}, {t.share}, {list(t.needed)}, {t.looked_up})" for k, t in enumerate(license_scan.PHRASES + license_scan.NOTICES))

OP11 = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT *, string_split(text, ' ') AS tw FROM (VALUES {_TEMPLATES}) v(k, label, phrase, text, drift, share, keys, looked_up)),
p AS (SELECT k, looked_up, word, min(pl) AS pl FROM (SELECT k, looked_up, unnest(tw) AS word, unnest(range(0, len(tw))) AS pl FROM t) GROUP BY ALL),
v AS (SELECT r, unnest(w) AS word, unnest(range(0, len(w))) AS pl FROM d), f AS (SELECT word, count(DISTINCT r) AS df FROM v WHERE word IN (SELECT word FROM p) GROUP BY 1),
ranked AS (SELECT p.*, coalesce(df, 0) AS df, row_number() OVER (PARTITION BY k ORDER BY coalesce(df, 0), pl) AS rn FROM p LEFT JOIN f ON p.word = f.word),
a AS (SELECT k, looked_up, word, pl, rn, ln(CAST((SELECT count(*) FROM d) + 1 AS DOUBLE) / (df + 1)) + 1 AS idf FROM ranked WHERE rn <= {license_scan.ANCHORS}),
posting AS (SELECT k, word, pl FROM (SELECT t.k, unnest(tw) AS word, unnest(range(0, len(tw))) AS pl FROM t) x SEMI JOIN (SELECT k, word FROM a WHERE rn <= looked_up) y USING (k, word)),
c AS (SELECT DISTINCT r, k, v.pl - posting.pl AS start FROM v JOIN posting ON v.word = posting.word),
s AS (SELECT c.r, c.k, c.start, sum(CASE WHEN list_contains(w[greatest(c.start + a.pl - drift, 0) + 1 : c.start + a.pl + drift + 1], word) THEN idf ELSE 0 END) / sum(idf) AS got
  FROM c JOIN t ON c.k = t.k JOIN a ON c.k = a.k JOIN d ON c.r = d.r GROUP BY 1, 2, 3),
m AS (SELECT s.r, label, phrase, s.start, got FROM s JOIN t ON s.k = t.k JOIN d ON s.r = d.r WHERE got >= share - 1e-9 AND len(list_filter(keys, lambda x: NOT contains(' ' || array_to_string(w[greatest(s.start - drift, 0) + 1 : s.start + len(tw) + drift], ' ') || ' ', ' ' || x || ' '))) = 0),
g AS (SELECT r, count_if(phrase) AS n_base, min(CASE WHEN phrase THEN start END) AS first_word, max(CASE WHEN phrase THEN start END) AS last_word, max(got) AS score,
  array_to_string(list_sort(list_distinct(list(CASE WHEN phrase THEN label END))), ',') AS base_labels, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels FROM m GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0), 6) AS score
FROM d LEFT JOIN g ON d.r = g.r"""
