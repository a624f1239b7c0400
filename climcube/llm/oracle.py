"""SQL for DuckDB that gives the rows of the registered queries, written from the contracts."""

from __future__ import annotations

_ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)


def _of_kind(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, {least} AS least,
        string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS m,
        regexp_extract_all(t, '{pattern}', {group}) AS g FROM d"""


SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
pieces AS ({_of_kind("assign", 0, _ASSIGN, 1, 8)}
  UNION ALL {_of_kind("access", 1, "AKIA[A-Z0-9]+", 0, 16)}
  UNION ALL {_of_kind("hex", 2, "[0-9a-f]+", 0, 32)}),
each AS (SELECT doc_id, kind, rank, least, unnest(m) AS m, unnest(g) AS g, unnest(gaps[1:len(m)]) AS gap,
                unnest(range(len(m))) AS i FROM pieces WHERE len(m) > 0),
placed AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM each),
spans AS (SELECT doc_id, kind, rank, stop - length(m) AS start, stop FROM placed WHERE length(g) >= least),
found AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (doc_id)
"""


def _split(table: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}"


DECONTAMINATION = f"""
WITH d AS ({_split("documents", "doc_id")}), b AS ({_split("benchmark", "CAST(item_id AS VARCHAR) AS item")}),
cuts AS (SELECT item, w, unnest(range(greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, array_to_string(w[i + 1 : i + 13], ' ') AS words, least(len(w), 13) AS n FROM cuts),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d JOIN sizes ON len(w) >= n),
hits AS (SELECT DISTINCT doc_id, i, p.n, item FROM places p
         JOIN windows x ON x.n = p.n AND x.words = array_to_string(w[i + 1 : i + p.n], ' ')),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
            FROM (SELECT doc_id, i + unnest(range(n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


_SHARE = "1 + (1000000000::HUGEINT * ({n} + 5)) // ({total} + 5 * v)"

DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n,
                 sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total,
                 sum(k.n) OVER (PARTITION BY g.lang, g.source) AS lang_total,
                 count(*) OVER (PARTITION BY g.lang, g.source) AS v
          FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
shares AS (SELECT lang, source, term, n, {_SHARE.format(n="n", total="total")} AS p,
                  {_SHARE.format(n="lang_n", total="lang_total")} AS q FROM dense),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def _vector_codes() -> str:
    """Four rounds and the last assignment, each as joined tables of one component a row."""
    ctes = ["""kept AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 1024) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))))""",
            """parts AS (SELECT r, p, list_transform(v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4], lambda x: x::DOUBLE) AS w
  FROM kept, (SELECT unnest(range(4)) AS p))""",
            """book0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, w
  FROM parts JOIN kept USING (r) QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 256)"""]
    for i in range(5):
        ctes.append(f"""near{i} AS (SELECT r, a.p, a.w, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT r, a.p, a.w, b.e, list_inner_product(a.w, a.w) - 2 * list_inner_product(a.w, b.w) + list_inner_product(b.w, b.w) AS d
    FROM parts a JOIN book{i} b ON a.p = b.p) a GROUP BY r, a.p, a.w)""")
        if i < 4:
            ctes.append(f"""mean{i} AS (SELECT p, e, list(m ORDER BY i) AS w FROM (
    SELECT p, e, i, floor(sum(x) / count(*)) AS m FROM (SELECT p, e, unnest(w) AS x, unnest(range(len(w))) AS i FROM near{i})
    GROUP BY p, e, i) GROUP BY p, e)""")
            ctes.append(f"""book{i + 1} AS (SELECT b.p, b.e, coalesce(m.w, b.w) AS w FROM book{i} b LEFT JOIN mean{i} m ON m.p = b.p AND m.e = b.e)""")
    ctes.append("""coded AS (SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near4 GROUP BY r)""")
    ctes.append("""books AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS h
  FROM (SELECT p, e, unnest(w) AS x, unnest(range(len(w))) AS i FROM book4))""")
    listed = ",\n".join(f"{c.replace(' AS (', ' AS MATERIALIZED (', 1)}" for c in ctes)
    return f"""WITH {listed}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (r), books"""


LINES = """
WITH lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
               FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT doc_id, line, i, last IS NULL OR doc_id = last AS stays FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def statements() -> dict[str, str]:
    return {
        "op1_secret_scan": SECRETS, "op8_decontamination": DECONTAMINATION, "op11_source_divergence": DIVERGENCE,
        "op12_vector_codes": _vector_codes(), "op13_line_dedup": LINES,
    }
