"""DuckDB statements that compute the same rows as the operators."""

from __future__ import annotations

from quaylake.llm import hardneg, linkgraph, mixing, rules


def _quality_rules_sql() -> str:
    r, strata = rules.RULES, rules.STRATA
    tests = sum(len(x.cutoffs) for x in r) * len(strata)
    stratum = "CASE " + " ".join(f"WHEN n_words >= {least} THEN '{name}'" for name, least in reversed(strata)) + " END"
    reached = " UNION ALL ".join(
        "SELECT rid, {s} AS stratum, {i} AS rule, {hits} AS reached FROM base".format(
            s=stratum, i=i, hits=" + ".join(
                f"(CASE WHEN {x.numerator}::DOUBLE / greatest(n_words, 1)::DOUBLE {'>' if x.above else '<'} {c!r}::DOUBLE"
                " THEN 1 ELSE 0 END)" for c in x.cutoffs)) for i, x in enumerate(r))
    p = rules.RISK / len(r)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
toks AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM docs),
lines AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
          FROM toks),
pos AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM toks WHERE len(w) >= 3),
wins AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win FROM pos),
again AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM wins),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n > 1)
            GROUP BY rid),
base AS (SELECT k.rid, k.doc_id, len(k.w)::BIGINT AS n_words,
                coalesce(list_sum(list_transform(k.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                (len(l.l) - len(list_distinct(l.l)))::BIGINT AS n_dup_lines,
                coalesce(c.n, 0)::BIGINT AS n_repeat_words
         FROM toks k JOIN lines l USING (rid) LEFT JOIN covered c USING (rid)),
reached AS ({reached}),
lab AS (SELECT doc_id, min(quality) AS label FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
hold AS (SELECT x.stratum, x.rule, x.reached, g.label
         FROM reached x JOIN base b USING (rid) JOIN lab g USING (doc_id)
         WHERE NOT (b.n_words < 50 OR 100 * b.n_repeat_words > 50 * b.n_words)),
size AS (SELECT stratum, rule, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS n FROM hold GROUP BY 1, 2),
levels AS (SELECT stratum, rule, label, unnest(range(1, reached + 1)) AS level FROM hold WHERE reached > 0),
cuts AS (SELECT stratum, rule, level, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS k,
                sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS caught FROM levels GROUP BY 1, 2, 3),
tests AS (SELECT c.*, s.n, c.caught - {rules.CLEAN_COST} * c.k AS gain,
                 CASE WHEN c.k > s.n * {p!r}::DOUBLE THEN 1 WHEN s.n = 0 THEN 1 ELSE
                 list_sum(list_transform(range(0, c.k::BIGINT + 1), lambda j:
                   exp(lgamma(s.n + 1.0) - lgamma(j + 1.0) - lgamma(s.n - j + 1.0)
                       + j * ln({p!r}::DOUBLE) + (s.n - j) * ln(1 - {p!r}::DOUBLE)))) END AS tail
          FROM cuts c JOIN size s USING (stratum, rule)),
best AS (SELECT stratum, rule, arg_max(level, (gain, level)) AS lim FROM tests
         WHERE gain > 0 AND tail <= {rules.DELTA!r} / {tests} GROUP BY 1, 2),
bad AS (SELECT DISTINCT x.rid FROM reached x JOIN best b USING (stratum, rule) WHERE x.reached >= b.lim)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND bad.rid IS NULL AS kept
FROM base b LEFT JOIN bad USING (rid)"""


def _propagation_sql() -> str:
    upper = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rs = sorted(linkgraph.RULES, key=lambda r: -len(r.text))
    fit = "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'"
        for r in rs) + " END"
    action = "CASE fit " + " ".join(f"WHEN '{r.text}' THEN '{r.action}'" for r in rs) + " END"
    link = linkgraph.LINK.replace("'", "''")
    a = linkgraph.DAMPING
    return f"""
WITH RECURSIVE parsed AS (SELECT page_id, html, {upper.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1)")} AS host,
                       regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
fitted AS (SELECT page_id, host, path, {fit} AS fit FROM parsed),
judged AS (SELECT *, {action} AS action FROM fitted),
links AS (SELECT DISTINCT host AS src, unnest(list_transform(regexp_extract_all(coalesce(html, ''), '{link}', 1),
                 lambda x: {upper.format('x')})) AS dst FROM parsed WHERE host <> ''),
hosts AS (SELECT host FROM parsed WHERE host <> '' UNION SELECT dst FROM links),
nodes AS (SELECT DISTINCT unnest(list_transform(range(1, len(l) + 1), lambda i: array_to_string(l[i:], '.'))) AS host
          FROM (SELECT string_split(host, '.') AS l FROM hosts)),
parents AS (SELECT host, substr(host, instr(host, '.') + 1) AS up FROM nodes WHERE contains(host, '.')),
edges AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM links UNION ALL SELECT host, up FROM parents
          UNION ALL SELECT up, host FROM parents) WHERE src <> dst),
steps AS (SELECT src AS host, dst AS "to", 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS wt, 0.0::DOUBLE AS wd FROM edges
          UNION ALL
          SELECT dst, src, 0.0, 1.0::DOUBLE / count(*) OVER (PARTITION BY dst) FROM edges),
gains AS (SELECT 0 AS round, host, {1 - a!r} * max(CASE WHEN action = 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS t,
                 {1 - a!r} * max(CASE WHEN action = 'block' THEN 1.0::DOUBLE ELSE 0 END) AS d
          FROM judged WHERE host <> '' AND action IS NOT NULL GROUP BY host
          UNION ALL
          SELECT round, host, t, d FROM (
              SELECT *, max(greatest(t, d)) OVER () AS most FROM (
                  SELECT g.round + 1 AS round, e."to" AS host, sum({a} * g.t * e.wt) AS t, sum({a} * g.d * e.wd) AS d
                  FROM gains g JOIN steps e USING (host) GROUP BY g.round, e."to")) WHERE most >= {linkgraph.TOLERANCE!r}),
scores AS (SELECT host, sum(t) AS t, sum(d) AS d FROM gains GROUP BY host)
SELECT j.page_id, j.host, j.path, j.fit AS rule,
       coalesce(j.action, CASE WHEN round(s.d - s.t, 9) > {linkgraph.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN scores s USING (host)"""


def _mixing_sql() -> str:
    turns = ", ".join(f"{float(w)!r}::DOUBLE" for w in mixing.SOURCE_WEIGHTS)
    most, least = f"{float(mixing.MOST_EPOCHS)!r}::DOUBLE", f"{mixing.LEAST_WEIGHT!r}::DOUBLE"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
                      string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
rows AS (SELECT rid, doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS solid,
                length(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS letters,
                len(list_distinct(l))::DOUBLE / len(l)::DOUBLE AS lines,
                (('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), '|', t)), 1, {mixing.KEY_BITS // 4}))::BIGINT::DOUBLE + 0.5)
                / {float(1 << mixing.KEY_BITS)!r}::DOUBLE AS u FROM texts),
keyed AS (SELECT rid, doc_id, source, size, -ln(u) / (greatest(CASE WHEN solid > 0 THEN letters::DOUBLE / solid::DOUBLE ELSE 0 END, {least})
                * greatest(lines, {least})) AS key FROM rows),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
weighed AS (SELECT *, [{turns}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.SOURCE_WEIGHTS)} + 1)::INT] AS w
            FROM sizes),
-- the sources that stop at their cap come first in order of cap to weight
capped AS (SELECT *, {most} * source_size AS cap,
                  coalesce(sum({most} * source_size) OVER o, 0) AS held, coalesce(sum(w) OVER o, 0) AS gone,
                  sum(source_size) OVER () AS total, sum(w) OVER () AS every
           FROM weighed
           WINDOW o AS (ORDER BY {most} * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stop AS (SELECT arg_min(total::DOUBLE - held, gone) AS spare, min(gone) AS gone, min(every) - min(gone) AS share FROM capped
         WHERE cap >= (total::DOUBLE - held) / (every - gone) * w),
plan AS (SELECT source, source_size,
                CASE WHEN total = 0 THEN 0.0 WHEN cap < spare / share * w THEN cap ELSE spare * w / share END AS target
         FROM capped, stop),
budget AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS complete FROM plan),
ordered AS (SELECT k.rid, k.doc_id, k.source, k.size, k.key, b.source_size, b.target, b.complete,
                   b.target - b.complete * b.source_size AS spare,
                   sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.rid) AS upto
            FROM keyed k JOIN budget b ON k.source IS NOT DISTINCT FROM b.source),
past AS (SELECT source, arg_min(rid, (key, rid)) AS past, arg_min(size, (key, rid)) AS psize, any_value(spare) AS spare
         FROM ordered WHERE upto > spare AND spare > 0 AND complete < {most} AND size > 0 GROUP BY source),
gaps AS (SELECT p.source, p.past, p.psize, p.spare,
                p.spare + p.psize - max(CASE WHEN o.upto <= p.spare + p.psize THEN o.upto ELSE 0 END) AS without,
                p.spare - p.psize - max(CASE WHEN o.upto <= p.spare - p.psize THEN o.upto ELSE 0 END) AS having_it
         FROM past p JOIN ordered o ON o.source IS NOT DISTINCT FROM p.source
         GROUP BY p.source, p.past, p.psize, p.spare),
cut AS (SELECT *, psize <= spare AND having_it < without AS takes,
               CASE WHEN psize <= spare AND having_it < without THEN having_it ELSE without END AS gap,
               CASE WHEN psize <= spare AND having_it < without THEN spare - psize ELSE spare + psize END AS lim FROM gaps),
sel AS (SELECT o.*, c.gap, c.source IS NOT DISTINCT FROM o.source AND c.past IS NOT NULL
               AND CASE WHEN o.rid = c.past THEN c.takes ELSE o.upto <= c.lim END AS chosen
        FROM ordered o LEFT JOIN cut c ON o.source IS NOT DISTINCT FROM c.source),
closing AS (SELECT source, arg_min(rid, (abs(gap - size), key, rid)) AS rid
            FROM sel WHERE NOT chosen AND size > 0 AND abs(gap - size) < gap GROUP BY source)
SELECT f.doc_id, f.size, f.source_size, f.target::DOUBLE AS target,
       (f.size * (f.complete + CASE WHEN f.chosen OR f.rid = c.rid THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sel f LEFT JOIN closing c ON f.source IS NOT DISTINCT FROM c.source"""


def _hard_negatives_sql() -> str:
    h = hardneg
    return f"""
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda x: floor({h.FACTOR} * x::DOUBLE)) AS v
              FROM embeddings
              WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
                  list_inner_product(a.v, c.v)::BIGINT AS score
           FROM rows a JOIN rows c ON a.vec_id <> c.vec_id WHERE a.vec_id % {h.ANCHOR_EVERY} = 0),
near AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
         QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {h.POSITIVES})
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM near p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND {h.LOW} * p.positive_score <= {h.SCALE} * s.score AND {h.SCALE} * s.score <= {h.HIGH} * p.positive_score
QUALIFY rank <= {h.NEGATIVES}"""


MIXING_SQL = _mixing_sql()
HARD_NEGATIVES_SQL = _hard_negatives_sql()
QUALITY_RULES_SQL = _quality_rules_sql()
PROPAGATION_SQL = _propagation_sql()
