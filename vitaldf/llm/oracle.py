"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from vitaldf.llm import license_scan, mixing, secret_scan, topk


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


#: DuckDB's matcher never recurses and has neither possessive repetition nor lookahead; here a body
#: ends at any five dashes
_KEY = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+)*-----END [A-Z ]*PRIVATE KEY-----"
        r"|(?:[ \t\r\n]+[A-Za-z-]+: [^\r\n]*)*[ \t\r\n\\]*[A-Za-z0-9+/\\]{16}[A-Za-z0-9+/=\\\r\n]*"
        r"(?:[ \t]+[A-Za-z0-9+/]{16}[A-Za-z0-9+/=\\\r\n]*)*(?:[ \t]+[A-Za-z0-9+/=]+(?:[\r\n]|$))?)?")


def _secrets() -> str:
    parts = []
    for i, r in enumerate(secret_scan.RULES):
        regex = _text(_KEY if r.kind == "private_key" else r.regex)
        parts.append(
            f"SELECT * FROM (SELECT row_no, {_text(r.kind)} AS kind, {i} AS ord, {r.least} AS least, "
            f"string_split_regex(text, {regex}) AS gaps, regexp_extract_all(text, {regex}, 0) AS hits, "
            f"regexp_extract_all(text, {regex}, {r.value}) AS vals FROM d) WHERE len(hits) > 0")
    base = ", ".join(map(_text, secret_scan.BASE_KINDS))
    counts = ", ".join(f"count(*) FILTER (kind = {_text(k)}) AS n_{k}" for k in secret_scan.BASE_KINDS)
    span = "kind || ':' || start || ':' || (start + n)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(parts)}),
e AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
s AS (SELECT row_no, kind, ord, length(hits[i]) AS n,
        (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
      FROM e WHERE length(vals[i]) >= least)
SELECT any_value(doc_id) AS doc_id, {counts},
  sha256(coalesce(string_agg({span}, ',' ORDER BY start, ord) FILTER (kind IN ({base})), '')) AS base_sha256,
  coalesce(string_agg({span}, ',' ORDER BY start, ord) FILTER (kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN s USING (row_no) GROUP BY row_no"""


def _licenses() -> str:
    rows = ", ".join(f"({i}, {_text(n)}, {_text(t)})" for i, (n, t) in enumerate(license_scan.TEMPLATES))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    t, room = f"{license_scan.THRESHOLD}::DOUBLE", f"{license_scan.ROOM}::DOUBLE"

    def words(col):
        return f"regexp_extract_all(translate({col}, '{upper}', '{lower}'), '[a-z0-9]+')"

    pairs = "unnest(list_transform(range(1, greatest(len(w), 1)), lambda k: w[k] || ' ' || w[k + 1])) AS pair"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
ta AS (SELECT i, name, {pairs} FROM (SELECT i, name, {words('template')} AS w FROM (VALUES {rows}) AS v(i, name, template))),
tb AS (SELECT DISTINCT i, pair FROM ta),
ts AS (SELECT i, any_value(name) AS name, count(DISTINCT pair) AS size,
        floor(count(*) * (2 - {t}) / {t} + {room})::BIGINT AS reach FROM ta GROUP BY i),
b AS (SELECT row_no, {pairs}, unnest(range(0, greatest(len(w) - 1, 0))) AS pos
      FROM (SELECT row_no, {words('text')} AS w FROM d)),
hits AS (SELECT row_no, i, pos, pair FROM b JOIN tb USING (pair)),
cand AS (SELECT row_no, i FROM hits JOIN ts USING (i) GROUP BY row_no, i, size
         HAVING count(DISTINCT pair) >= size * {t} / (2 - {t}) - {room}),
near AS (SELECT row_no, i, pos, pos - row_number() OVER (PARTITION BY row_no, i ORDER BY pos) AS run
         FROM hits JOIN cand USING (row_no, i)),
runs AS (SELECT row_no, i, min(pos) AS s, max(pos) AS e FROM near GROUP BY row_no, i, run),
wins AS (SELECT x.row_no, x.i, x.s, y.e FROM runs x JOIN ts USING (i)
         JOIN runs y ON y.row_no = x.row_no AND y.i = x.i AND y.s >= x.s AND (y.s = x.s OR y.e - x.s < reach)),
counts AS (SELECT wins.row_no, wins.i, s, e, count(DISTINCT b.pair) AS n, count(DISTINCT tb.pair) AS shared
           FROM wins JOIN b ON b.row_no = wins.row_no AND b.pos BETWEEN s AND e
           LEFT JOIN tb ON tb.i = wins.i AND tb.pair = b.pair GROUP BY wins.row_no, wins.i, s, e),
m AS (SELECT row_no, i, name, s, e, shared, 2.0::DOUBLE * shared / (n + size) AS dice
      FROM counts JOIN ts USING (i) WHERE 2.0::DOUBLE * shared / (n + size) >= {t}),
g AS (SELECT row_no, list_reduce(
        list([{{'name': name, 'dice': dice, 's': s, 'e': e}}] ORDER BY shared DESC, dice DESC, s, e, i),
        lambda kept, x: CASE WHEN len(list_filter(kept, lambda k: k.s <= x[1].e AND x[1].s <= k.e)) > 0
                             THEN kept ELSE kept || x END) AS kept FROM m GROUP BY row_no),
u AS (SELECT row_no, unnest(kept) AS k FROM g),
r AS (SELECT row_no, first(k.name ORDER BY k.dice DESC, k.name) AS license, max(k.dice) AS dice,
        string_agg(DISTINCT k.name, ',' ORDER BY k.name) AS licenses,
        string_agg(k.name || ':' || k.s || ':' || (k.e + 2), ',' ORDER BY k.s) AS notices FROM u GROUP BY row_no)
SELECT doc_id, license, coalesce(dice, 0.0::DOUBLE) AS dice, coalesce(licenses, '') AS licenses,
  coalesce(notices, '') AS notices
FROM d LEFT JOIN r USING (row_no)"""


def _mixing() -> str:
    digits = mixing._DIGITS
    identity = f"'{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))"
    return f"""
WITH s AS (SELECT source, sum(strlen(coalesce(text, '')))::DOUBLE AS bytes FROM documents GROUP BY source),
r AS (SELECT source, CASE WHEN bytes = 0 THEN 1.0 ELSE pow(bytes, {mixing.ALPHA}::DOUBLE)
        / (SELECT sum(pow(bytes, {mixing.ALPHA}::DOUBLE)) FROM s) * (SELECT sum(bytes) FROM s) / bytes END
        AS rate FROM s),
p AS (SELECT source, j, rate, sum(CASE WHEN j = 0 THEN -rate ELSE ln(rate / j) END)
        OVER (PARTITION BY source ORDER BY j) AS log_p
      FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS j FROM r)),
c AS (SELECT source, j, sum(exp(log_p)) OVER (PARTITION BY source ORDER BY j) AS cdf FROM p),
l AS (SELECT source, list(cdf) AS cdf FROM c GROUP BY source),
w AS (SELECT doc_id, source, text, md5({identity}) AS who FROM documents),
u AS (SELECT *, (('0x' || substr(who, 1, {digits}))::BIGINT + 0.5::DOUBLE) / pow(16.0::DOUBLE, {digits}) AS u
      FROM w),
n AS (SELECT u.*, len(list_filter(l.cdf, lambda x: x < u.u)) AS n
      FROM u JOIN l ON u.source IS NOT DISTINCT FROM l.source),
k AS (SELECT doc_id, source, strlen(coalesce(text, ''))::BIGINT AS n_bytes, who,
        unnest(range(0, n)) AS copy FROM n)
SELECT doc_id, source, n_bytes, copy, md5(who || ':' || copy) AS shuffle_key FROM k"""


def _top_k() -> str:
    good = "x IS NOT NULL AND isfinite(x)"
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: {good})) = len(embedding)),
p AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q),
        lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {topk.K}"""


SECRETS, LICENSES, MIXING, TOP_K = _secrets(), _licenses(), _mixing(), _top_k()

COLLOCATIONS = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k AS words, unnest(list_transform(range(1, len(ws) - k + 2),
        lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) AS v(k)),
c AS (SELECT lang, words, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM c WHERE words = 1 GROUP BY lang),
x AS (SELECT *, string_split(phrase, ' ') AS ws FROM c WHERE words > 1 AND a >= 10),
cut AS (SELECT x.lang, x.words, x.phrase, x.a, k, l.a AS l, r.a AS r,
          ((1000000::HUGEINT * x.a * x.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
        FROM (SELECT *, unnest(range(1, words)) AS k FROM x) AS x
        JOIN c AS l ON l.lang = x.lang AND l.phrase = array_to_string(ws[1:k], ' ')
        JOIN c AS r ON r.lang = x.lang AND r.phrase = array_to_string(ws[k + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, max(a) AS most FROM (
             SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase
             FROM x WHERE words = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.phrase = best.phrase
           AND best.words = 2 WHERE most IS NULL OR 100 * most < 50 * best.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""
