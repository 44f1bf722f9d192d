"""DuckDB SQL with the results of the operators that SQL can express.

Written apart from the Spark code: matches are rows, positions a running sum
over them, and checks are plain list arithmetic.
"""

from __future__ import annotations

from ordwise.llm import lexical, pii, secrets
from ordwise.plans.oracle import CRC_TABLE_CTE, _crc_of_hex

# The contract's patterns as they stand; RE2 needs neither look-around nor possessive marks.
_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    "id_number": r"[0-9-]+",
    "short_card": r"[0-9](?:[\x20-]?[0-9])+",
}
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = (f"list_sum(list_transform(generate_series(1, length({_DIGITS})), lambda i: "
         f"(CASE WHEN i % 2 = 0 THEN [0, 2, 4, 6, 8, 1, 3, 5, 7, 9] ELSE [0, 1, 2, 3, 4, 5, 6, 7, 8, 9] END)"
         f"[CAST(substr(reverse({_DIGITS}), i, 1) AS INTEGER) + 1])) % 10 = 0")
_MOVED = "(substr(replace(v, ' ', ''), 5) || substr(replace(v, ' ', ''), 1, 4))"
_SPELT = (f"list_aggregate(list_transform(string_split({_MOVED}, ''), lambda c: "
          "CASE WHEN c >= 'A' THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), 'string_agg', '')")
_PII_VALID = {
    "email": "true",
    "ip": "len(list_filter(string_split(v, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
    "iban": f"list_reduce(list_transform(string_split({_SPELT}, ''), lambda c: CAST(c AS INTEGER)), "
            "lambda a, c: (a * 10 + c) % 97) = 1",
    "id_number": "regexp_full_match(v, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND NOT regexp_matches(v, "
                 "'^(000|666|9)|-00-|-0000$')",
    "short_card": f"length({_DIGITS}) BETWEEN 13 AND 15 AND {_LUHN}",
}
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)"""
_SECRETS = {
    "assign": _ASSIGN, "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+",
    "private_key": secrets.PATTERNS["private_key"], "bearer": secrets.PATTERNS["bearer"],
    "provider": secrets.PATTERNS["provider"],
}
_SECRETS_VALID = {"assign": f"length(regexp_extract(v, '{_ASSIGN}', 1)) >= 12", "access": "length(v) >= 18",
                  "hex": "length(v) >= 16"}


def _matches(patterns: dict, valid: dict) -> str:
    """m(doc_id, t, o, kind, s, e, v): valid matches with their kind's place and their position."""
    each = " UNION ALL ".join(
        f"SELECT doc_id, t, {o} AS o, '{kind}' AS kind, regexp_extract_all(t, '{p}') AS h, "
        f"regexp_split_to_array(t, '{p}') AS g FROM d" for o, (kind, p) in enumerate(patterns.items()))
    ok = " ".join(f"WHEN '{k}' THEN {x}" for k, x in valid.items())
    return f"""d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS ({each}),
r AS (SELECT doc_id, t, o, kind, unnest(h) AS v, unnest(g[1:len(h)]) AS gap, generate_subscripts(h, 1) AS i FROM a),
p AS (SELECT doc_id, t, o, kind, v, CAST(sum(length(gap) + length(v)) OVER (
        PARTITION BY doc_id, o ORDER BY i) AS BIGINT) AS e FROM r),
m AS (SELECT doc_id, t, o, kind, e - length(v) AS s, e, v FROM p WHERE CASE kind {ok} ELSE true END)"""


def _digest(base: list[str], order: str) -> str:
    counts = ", ".join(f"count(x.doc_id) FILTER (x.kind = '{k}') AS n_{k}" for k in base)
    names = ", ".join(f"'{k}'" for k in base)
    one = "x.kind || ':' || x.s || ':' || x.e"
    return f"""SELECT d.doc_id, {counts},
  sha256(coalesce(string_agg({one}, ',' ORDER BY {order}) FILTER (x.kind IN ({names})), '')) AS base_sha256,
  coalesce(string_agg({one}, ',' ORDER BY {order}) FILTER (x.kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN x ON d.doc_id = x.doc_id GROUP BY d.doc_id"""


def _pii_sql() -> str:
    n = len(pii.BASE_KINDS)
    case = lambda values: "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"
    words = {k: f"'(^|[^a-z0-9_])(?:{v})'" for k, v in pii.CONTEXT.items()}
    c = pii.CONTEXT_CHARS
    near = (f"lower(substr(t, greatest(1, s - {c - 1}), least({c}, s)) || ' ' || substr(t, e + 1, {c}))")
    return f"""WITH {_matches(_PII, _PII_VALID)},
w AS (SELECT *, round(least(1.0, {case(pii.SCORES)} + CASE WHEN regexp_matches({near}, {case(words)})
        THEN {pii.CONTEXT_GAIN} ELSE 0.0 END), 2) AS score FROM m),
x AS (SELECT doc_id, o, kind, s, e FROM w WHERE o < {n}
  UNION ALL SELECT doc_id, o, kind, s, e FROM w WHERE o >= {n} AND score >= {pii.MIN_SCORE} AND NOT EXISTS (
    SELECT 1 FROM m b WHERE b.doc_id = w.doc_id AND b.o < {n} AND b.s < w.e AND w.s < b.e))
{_digest(pii.BASE_KINDS, "x.o, x.s")}"""


def _secrets_sql() -> str:
    return f"""WITH {_matches(_SECRETS, _SECRETS_VALID)},
x AS (SELECT doc_id, o, kind, s, e FROM m)
{_digest(secrets.BASE_KINDS, "x.s, x.o, x.e")}"""


_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(generate_series(1, least(len(q.v), len(c.v))), lambda i: q.v[i] * c.v[i]))
              AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


_CRC = _crc_of_hex("hex(CAST(conv_id AS VARCHAR))", "strlen(CAST(conv_id AS VARCHAR))")
# every node by its list of turns; the nodes of a subtree meet its top by their first turns
_TRIE = rf"""WITH {CRC_TABLE_CTE},
o AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS ts
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, ts, CAST({_CRC} % 4 AS BIGINT) AS h FROM o, crc_tab),
c AS (SELECT h.conv_id, coalesce(b.ts[1:h], []) || h.ts[h + 1:] AS ts
      FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, len(ts) AS size, d, ts[1:d] AS node FROM c, unnest(range(len(ts) + 1)) AS u(d)),
g AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '')) AS e,
             CASE WHEN d > 0 THEN len(regexp_extract_all(node[d].x, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
      FROM p GROUP BY node, d),
k AS (SELECT a.node, b.conv_id AS parent_conv_id FROM g a JOIN g b ON a.d = b.d + 1 AND a.node[1:a.d - 1] = b.node),
n AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1),
s AS (SELECT g.node[1:u.a] AS node, sum((n_convs - 1) * words) AS saved,
             count(*) FILTER (n.node IS NULL) AS leaves
      FROM g LEFT JOIN n ON n.node = g.node, unnest(range(g.d + 1)) AS u(a) GROUP BY 1)
SELECT g.conv_id, g.d AS depth, k.parent_conv_id, g.n_convs, coalesce(n.n_children, 0) AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, g.e AS ends_sha256
FROM g JOIN s ON s.node = g.node LEFT JOIN k ON k.node = g.node LEFT JOIN n ON n.node = g.node"""

_TERMS = f"regexp_extract_all(translate(text, '{lexical._A_Z}', '{lexical._A_Z.lower()}'), '{lexical.TERM}')"
_LEXICAL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
e AS (SELECT r, doc_id, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
z AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM e),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
t AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ts) AS term FROM e)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM t, z GROUP BY term, n_docs),
s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))
             AS BIGINT) AS score
      FROM q JOIN t USING (term) JOIN w USING (term), z GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= 50"""

_WARC = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest FROM pages),
b AS (SELECT *, max(page_id) OVER (PARTITION BY digest, size) AS top FROM p)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
       CASE WHEN size >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND page_id <> top THEN top END AS refers_to FROM b"""


def oracle_sql() -> dict[str, str]:
    return {"op2_pii": _pii_sql(), "op4_secrets": _secrets_sql(), "op10_topk": _TOP_K, "op11_prefix_trie": _TRIE,
            "op12_lexical": _LEXICAL, "op13_warc": _WARC}
