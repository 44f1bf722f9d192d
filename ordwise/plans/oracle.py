"""DuckDB SQL equivalents of ``ordwise.plans.catalog`` (the correctness oracle).

Written independently of the Spark code: the 128-bit generator runs as a
recursive CTE on two UHUGEINT halves, CRC-32 is a table built by its defining
rule and folded over the key bytes, and sorts are ``row_number()``.
"""

from __future__ import annotations

from ordwise.plans.catalog import (LINEITEM_KEY_COLS, LINEITEM_SORT, N_PARTS, SIZE_SUFFIXES,
                                   SKIP_MUL, VALUE_PAD)
from ordwise.schema import LCG_ADD, LCG_MUL, PREFIX_MAX

T64 = "18446744073709551616::UHUGEINT"
RPP = -(-PREFIX_MAX // N_PARTS)


def _u(x: int) -> str:
    return f"{x}::UHUGEINT"


def _mul(ah, al, bh, bl):
    """(hi, lo) of (a * b) mod 2^128 on 64-bit halves."""
    p = f"(({al}) * ({bl}))"
    lo = f"({p} % {T64})"
    hi = f"((({p} // {T64}) + ((({ah}) * ({bl})) % {T64}) + ((({al}) * ({bh})) % {T64})) % {T64})"
    return hi, lo


def _add(xh, xl, yh, yl):
    s = f"(({xl}) + ({yl}))"
    return f"((({xh}) + ({yh}) + {s} // {T64}) % {T64})", f"({s} % {T64})"


def _muladd(ah, al, xh, xl, ch, cl):
    mh, ml = _mul(ah, al, xh, xl)
    return _add(mh, ml, ch, cl)


def _powers_cte() -> str:
    """pw(j, ah, al, ch, cl): the generator advanced 2^j steps."""
    a2h, a2l = _mul("ah", "al", "ah", "al")
    c2h, c2l = _muladd("ah", "al", "ch", "cl", "ch", "cl")
    return f"""pw(j, ah, al, ch, cl) AS (
  SELECT 0, {_u(LCG_MUL >> 64)}, {_u(LCG_MUL & (2**64 - 1))}, {_u(LCG_ADD >> 64)}, {_u(LCG_ADD & (2**64 - 1))}
  UNION ALL
  SELECT j + 1, {a2h}, {a2l}, {c2h}, {c2l} FROM pw WHERE j < 62
)"""


def _records_sql(recs_sql: str, extra_cols: str = "") -> str:
    """recs_sql yields (r, ...extra); output adds hex state S per record r (record r uses X[r+1])."""
    nh, nl = _muladd("pw.ah", "pw.al", "st.sh", "st.sl", "pw.ch", "pw.cl")
    extra_sel = (", " + ", ".join(f"st.{c}" for c in extra_cols.split(","))) if extra_cols else ""
    extra_decl = (", " + extra_cols) if extra_cols else ""
    return f"""WITH RECURSIVE {_powers_cte()},
recs AS ({recs_sql}),
st(r, j, sh, sl{extra_decl}) AS (
  SELECT r, 0, 0::UHUGEINT, 0::UHUGEINT{(", " + extra_cols) if extra_cols else ""} FROM recs
  UNION ALL
  SELECT st.r, st.j + 1,
    CASE WHEN ((st.r + 1) >> st.j) & 1 = 1 THEN {nh} ELSE st.sh END,
    CASE WHEN ((st.r + 1) >> st.j) & 1 = 1 THEN {nl} ELSE st.sl END{extra_sel}
  FROM st JOIN pw ON pw.j = st.j
  WHERE ((st.r + 1) >> st.j) > 0
),
states AS (
  SELECT *, lpad(hex(sh), 16, '0') || lpad(hex(sl), 16, '0') AS s_hex
  FROM st WHERE ((r + 1) >> j) = 0
)"""


def _value_hex(r: str, s_hex: str) -> str:
    recno = f"hex(lpad(hex({r}), 32, '0'))"
    filler = f"hex(regexp_replace(substr({s_hex}, 21, 12), '(.)', '\\1\\1\\1\\1', 'g'))"
    return f"'0011' || {recno} || '8899AABB' || {filler} || 'CCDDEEFF'"


CRC_TABLE_CTE = """crc_tab AS (
  SELECT list(list_reduce(range(8),
      lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END,
      n::UBIGINT) ORDER BY n) AS t
  FROM range(256) r(n)
)"""


def _crc_of_hex(h: str, n_bytes: int = 10) -> str:
    """CRC-32 of the bytes spelled by hex text ``h`` (needs crc_tab column ``t`` in scope)."""
    return (f"xor(list_reduce(range({n_bytes}), lambda c, i: xor(t[(xor(c, ('0x' || substr({h}, 2 * i + 1, 2))"
            f"::UBIGINT) & 255)::BIGINT + 1], c >> 8), 4294967295::UBIGINT), 4294967295::UBIGINT)")


def _md5_key_hex(expr: str) -> str:
    return f"upper(substr(md5(CAST({expr} AS VARCHAR)), 1, 20))"


def _md5_key_hex_cols(cols) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"upper(substr(md5(concat_ws('|', {parts})), 1, 20))"


def _prefix(kh: str) -> str:
    return f"('0x' || substr({kh}, 1, 14))::UBIGINT::BIGINT"


def _pid(kh: str) -> str:
    return f"CAST(least({_prefix(kh)} // {RPP}, {N_PARTS - 1}) AS INTEGER)"


def _u128_hex(x: str) -> str:
    return f"lower(hex(CAST({x} AS HUGEINT)))"


KEYED_ORDERS = f"SELECT o_orderkey, o_custkey, {_md5_key_hex('o_orderkey')} AS kh FROM orders"

SUMMARY = f"""WITH {CRC_TABLE_CTE},
k AS ({KEYED_ORDERS}),
s AS (
  SELECT {_pid('kh')} AS pid, count(*) AS n, min(kh) AS first_hex, max(kh) AS last_hex,
         sum({_crc_of_hex('kh')}) AS ck
  FROM k, crc_tab GROUP BY 1
)"""


ORDER_RECORDS = "SELECT o_orderkey AS r FROM orders"

# orders by partition of one key, with another key carried along
CROSS = f"""WITH {CRC_TABLE_CTE},
k AS (SELECT {_md5_key_hex('o_orderkey')} AS kh, {_md5_key_hex_cols(['o_custkey', 'o_orderkey'])} AS oh FROM orders),
s AS (SELECT {_pid('kh')} AS pid, arg_min(oh, kh) AS first_hex, arg_max(oh, kh) AS last_hex FROM k GROUP BY 1),
b AS (SELECT *, lag(last_hex) OVER (ORDER BY pid) AS prev_last_hex FROM s),
c AS (SELECT *, coalesce(first_hex < prev_last_hex, false) AS descent,
             NOT coalesce(first_hex < prev_last_hex, false) AND first_hex <= last_hex AS ok FROM b)"""


def oracle_sql() -> dict[str, str]:
    q = {}
    q["gen_records"] = _records_sql(ORDER_RECORDS) + f"""
SELECT r AS rec_no, substr(s_hex, 1, 20) AS key_hex, {_value_hex('r', 's_hex')} AS value_hex FROM states"""

    q["gen_skip_ahead"] = _records_sql(
        f"SELECT o_orderkey * {SKIP_MUL} + o_custkey AS r, o_orderkey AS ok FROM orders", "ok") + """
SELECT ok AS o_orderkey, r AS rec_no, substr(s_hex, 1, 20) AS key_hex FROM states"""

    q["key_prefix"] = f"""WITH k AS ({KEYED_ORDERS})
SELECT o_orderkey, {_prefix('kh')} AS prefix,
  array_to_string(list_transform(range(10), lambda i: ('0x' || substr(kh, 2 * i + 1, 2))::INTEGER), ',') AS key_bytes
FROM k"""

    q["even_range_partition"] = f"""WITH k AS ({KEYED_ORDERS})
SELECT o_orderkey, {_pid('kh')} AS pid FROM k"""

    q["sort_total_order"] = f"""WITH k AS ({KEYED_ORDERS})
SELECT row_number() OVER (ORDER BY kh) AS rk, kh AS key_hex, o_orderkey FROM k"""

    cols = ", ".join(LINEITEM_SORT)
    q["sort_table_sampled"] = f"""SELECT row_number() OVER (ORDER BY {", ".join(c + " NULLS FIRST" for c in LINEITEM_SORT)}) AS rk, {cols}
FROM lineitem"""

    q["gen_sort_rank"] = _records_sql(ORDER_RECORDS) + """
SELECT row_number() OVER (ORDER BY substr(s_hex, 1, 20)) AS rk, substr(s_hex, 1, 20) AS key_hex,
       """ + _value_hex('r', 's_hex') + """ AS value_hex, r AS rec_no
FROM states"""

    q["partition_summary"] = SUMMARY + f"""
SELECT pid, n, first_hex, last_hex, {_u128_hex('ck')} AS checksum_hex FROM s"""

    q["boundary_check"] = CROSS + """
SELECT pid, prev_last_hex, first_hex, last_hex, descent, ok FROM c"""

    q["order_violations"] = """SELECT o_custkey, CAST(sum(bad) AS BIGINT) AS n_bad FROM (
  SELECT o_custkey,
    CASE WHEN o_orderdate < lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)
         THEN 1 ELSE 0 END AS bad
  FROM orders) GROUP BY o_custkey"""

    q["hot_group_violations"] = """SELECT event_type, CAST(sum(bad) AS BIGINT) AS n_bad FROM (
  SELECT event_type,
    CASE WHEN value < lag(value) OVER (PARTITION BY event_type ORDER BY event_id)
         THEN 1 ELSE 0 END AS bad
  FROM events) GROUP BY event_type"""

    q["null_order_violations"] = """SELECT grp, CAST(sum(bad) AS BIGINT) AS n_bad FROM (
  SELECT grp, CASE WHEN lag(o_orderkey) OVER w IS NULL THEN 0
                   WHEN lag(k) OVER w IS NULL THEN 0
                   WHEN k IS NULL OR k < lag(k) OVER w THEN 1 ELSE 0 END AS bad
  FROM (SELECT o_orderkey, nullif(o_custkey % 7, 3) AS grp, nullif(o_orderkey * 7 % 11, 5) AS k
        FROM orders)
  WINDOW w AS (PARTITION BY grp ORDER BY o_orderkey)) GROUP BY grp"""

    q["null_sort_rank"] = """SELECT row_number() OVER (ORDER BY k NULLS FIRST, o_orderkey) AS rk, k, o_orderkey
FROM (SELECT nullif(o_custkey % 13, 4) AS k, o_orderkey FROM orders)"""

    q["validate_verdict"] = CROSS + f""",
d AS (SELECT {_crc_of_hex('oh')} AS crc,
        CASE WHEN oh < lag(oh) OVER (ORDER BY kh) THEN 1 ELSE 0 END AS bad
      FROM k, crc_tab)
SELECT count(*) AS n, {_u128_hex('sum(crc)')} AS checksum_hex, CAST(sum(bad) AS BIGINT) AS violations,
       (SELECT count(*) FROM c WHERE NOT ok) AS bad_boundaries,
       sum(bad) = 0 AND (SELECT count(*) FROM c WHERE NOT ok) = 0 AS ok FROM d"""

    q["gen_sort_validate"] = _records_sql(ORDER_RECORDS) + f""",
{CRC_TABLE_CTE},
rec AS (SELECT substr(s_hex, 1, 20) AS kh, substr(s_hex, 1, 20) || {_value_hex('r', 's_hex')} AS rh FROM states),
sums AS (SELECT count(*) AS n, {_u128_hex('sum(' + _crc_of_hex('rh', 100) + ')')} AS checksum_hex FROM rec, crc_tab),
turned AS (SELECT CAST(sum(CASE WHEN kh < p THEN 1 ELSE 0 END) AS BIGINT) AS violations
           FROM (SELECT kh, lag(kh) OVER (ORDER BY reverse(kh)) AS p FROM rec))
SELECT 'key' AS sorted_by, n, checksum_hex, CAST(0 AS BIGINT) AS violations, true AS ok FROM sums
UNION ALL
SELECT 'back', n, checksum_hex, violations, violations = 0 FROM sums, turned"""

    q["checksum_total"] = f"""WITH {CRC_TABLE_CTE},
k AS (SELECT {_md5_key_hex_cols(LINEITEM_KEY_COLS)} AS kh FROM lineitem)
SELECT count(*) AS n, {_u128_hex('sum(' + _crc_of_hex('kh') + ')')} AS checksum_hex FROM k, crc_tab"""

    q["compare_datasets"] = f"""WITH {CRC_TABLE_CTE},
k AS ({KEYED_ORDERS}),
s AS (SELECT count(*) AS n, sum({_crc_of_hex('kh')}) AS a,
        sum({_crc_of_hex("CASE WHEN o_orderkey % 1000 = 0 THEN '00000000000000000000' ELSE kh END")}) AS b
      FROM k, crc_tab)
SELECT 'written' AS pair, n AS n_a, n AS n_b, {_u128_hex('a')} AS checksum_a_hex, {_u128_hex('a')} AS checksum_b_hex,
       true AS same_n, true AS same_checksum FROM s
UNION ALL
SELECT 'changed', n, n, {_u128_hex('a')}, {_u128_hex('b')}, true, a = b FROM s"""

    q["fixed_record_roundtrip"] = f"""SELECT {_md5_key_hex('o_orderkey')} AS key_hex,
       hex(rpad(CAST(o_orderkey AS VARCHAR), {VALUE_PAD}, ' ')) AS value_hex FROM orders"""

    q["sorted_files_rank"] = f"""WITH k AS ({KEYED_ORDERS})
SELECT row_number() OVER (ORDER BY kh) AS rk, kh AS key_hex,
       hex(rpad(CAST(o_orderkey AS VARCHAR), {VALUE_PAD}, ' ')) AS value_hex FROM k"""

    suffixes = ", ".join(f"'{s}'" for s in SIZE_SUFFIXES)
    q["size_functions"] = f"""WITH s AS (
  SELECT doc_id, CAST(n_chars AS VARCHAR) || ([{suffixes}])[(doc_id % {len(SIZE_SUFFIXES)}) + 1] AS size_in
  FROM documents),
b AS (
  SELECT doc_id, size_in,
    CASE lower(right(size_in, 1))
      WHEN 'k' THEN CAST(left(size_in, length(size_in) - 1) AS BIGINT) * 1000
      WHEN 'm' THEN CAST(left(size_in, length(size_in) - 1) AS BIGINT) * 1000000
      WHEN 'g' THEN CAST(left(size_in, length(size_in) - 1) AS BIGINT) * 1000000000
      WHEN 't' THEN CAST(left(size_in, length(size_in) - 1) AS BIGINT) * 1000000000000
      ELSE CAST(size_in AS BIGINT) END AS bytes
  FROM s)
SELECT doc_id, size_in, bytes,
  CASE WHEN bytes > 1000000000000 THEN CAST(bytes // 1000000000000 AS VARCHAR) || 'TB'
       WHEN bytes > 1000000000 THEN CAST(bytes // 1000000000 AS VARCHAR) || 'GB'
       WHEN bytes > 1000000 THEN CAST(bytes // 1000000 AS VARCHAR) || 'MB'
       WHEN bytes > 1000 THEN CAST(bytes // 1000 AS VARCHAR) || 'KB'
       ELSE CAST(bytes AS VARCHAR) || 'B' END AS text
FROM b"""

    q["u128_hex"] = f"""WITH {CRC_TABLE_CTE},
k AS ({KEYED_ORDERS}),
per AS (SELECT o_custkey, sum({_crc_of_hex('kh')})::HUGEINT AS s FROM k, crc_tab GROUP BY 1)
SELECT o_custkey, {_u128_hex('s * 18446744073709551616::HUGEINT + s')} AS hex, true AS roundtrip_ok FROM per"""

    q["u128_full"] = """WITH m AS (SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)
SELECT o_orderkey, ltrim(h, '0') AS hex, CAST(('0x' || substr(h, 1, 16))::UBIGINT AS DECIMAL(20, 0)) AS high,
       CAST(('0x' || substr(h, 17, 16))::UBIGINT AS DECIMAL(20, 0)) AS low,
       upper(substr(h, 1, 1) || substr(h, 16, 2) || substr(h, 32, 1)) || '0' AS digits
FROM m"""

    pair = [f"('0x' || substr({h}, {at}, 16))::UBIGINT::UHUGEINT" for h in ("ha", "hb") for at in (1, 17)]
    sum_, product = _add(*pair), _mul(*pair)
    both = lambda hi, lo: f"lower(coalesce(nullif(ltrim(lpad(hex({hi}), 16, '0') || lpad(hex({lo}), 16, '0'), '0'), ''), '0'))"
    shift_hi = "CASE WHEN bits BETWEEN 64 AND 127 THEN 1::UHUGEINT << CAST(bits - 64 AS UHUGEINT) ELSE 0::UHUGEINT END"
    shift_lo = "CASE WHEN bits < 64 THEN 1::UHUGEINT << CAST(bits AS UHUGEINT) ELSE 0::UHUGEINT END"
    shifted = _mul(pair[0], pair[1], shift_hi, shift_lo)
    q["u128_arithmetic"] = f"""WITH m AS (SELECT o_orderkey, CAST(o_orderkey % 140 AS INTEGER) AS bits,
  md5(CAST(o_orderkey AS VARCHAR)) AS ha, md5(CAST(o_custkey AS VARCHAR)) AS hb FROM orders)
SELECT o_orderkey, {both(*sum_)} AS sum, {both(*product)} AS product, {both(*shifted)} AS shifted FROM m"""

    q["histogram_sort_rank"] = """WITH k AS (SELECT o_orderkey, hex('c' || lpad(CAST(o_custkey * o_custkey AS VARCHAR), 14, '0')
  || '/' || CAST(o_orderkey AS VARCHAR)) AS key_hex FROM orders)
SELECT row_number() OVER (ORDER BY key_hex) AS rk, key_hex, o_orderkey FROM k"""

    q["histogram_balance"] = f"""SELECT count(*) AS n, CAST({N_PARTS} AS BIGINT) AS parts, true AS balanced,
  CAST(0 AS BIGINT) AS violations FROM lineitem"""

    q["changed_ranges"] = f"""WITH {CRC_TABLE_CTE},
k AS (SELECT {_md5_key_hex('o_orderkey')} AS kh, hex(rpad(CAST(o_custkey AS VARCHAR), 10, ' ')) AS va,
             CASE WHEN o_orderkey % 1000 = 0 THEN hex('changed...') ELSE hex(rpad(CAST(o_custkey AS VARCHAR), 10, ' ')) END AS vb
      FROM orders),
c AS (SELECT kh, {_crc_of_hex('(kh || va)', 20)} AS a, {_crc_of_hex('(kh || vb)', 20)} AS b FROM k, crc_tab),
leaf AS (SELECT substr(kh, 1, 4) AS leaf, count(*) AS n, sum(a) AS a, sum(b) AS b FROM c GROUP BY 1),
node AS (SELECT CAST(level AS INTEGER) AS level, substr(leaf, 1, CAST(2 * level AS BIGINT)) AS prefix, sum(n) AS n, sum(a) AS a, sum(b) AS b,
                count(*) FILTER (a <> b) AS leaves FROM leaf, range(3) AS r(level) GROUP BY ALL)
SELECT level, prefix, CAST(n AS BIGINT) AS n_a, CAST(n AS BIGINT) AS n_b, {_u128_hex('a')} AS checksum_a_hex,
       {_u128_hex('b')} AS checksum_b_hex, leaves FROM node WHERE leaves > 0"""

    # unsorted files hold the orders in the order of the table
    q["manifest_verdict"] = f"""WITH {CRC_TABLE_CTE},
k AS (SELECT {_md5_key_hex('o_orderkey')} AS kh, row_number() OVER () AS r FROM orders),
s AS (SELECT count(*) AS n, {_u128_hex('sum(' + _crc_of_hex('kh') + ')')} AS checksum_hex FROM k, crc_tab),
u AS (SELECT CAST(sum(CASE WHEN kh < p THEN 1 ELSE 0 END) AS BIGINT) AS violations
      FROM (SELECT kh, lag(kh) OVER (ORDER BY r) AS p FROM k))
SELECT f.files, c.scan, n, checksum_hex, CASE f.files WHEN 'sorted' THEN 0 ELSE violations END AS violations,
       f.files = 'sorted' OR violations = 0 AS ok
FROM s, u, (VALUES ('sorted'), ('unsorted')) f(files), (VALUES (true), (false)) c(scan)"""

    q["key_range_read"] = f"""SELECT kh AS key_hex, CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM ({KEYED_ORDERS})
WHERE kh >= '30' AND kh < '3A80'"""

    q["observed_phases"] = _records_sql(ORDER_RECORDS) + f""",
{CRC_TABLE_CTE},
rec AS (SELECT substr(s_hex, 1, 20) || {_value_hex('r', 's_hex')} AS rh FROM states),
sums AS (SELECT count(*) AS n, {_u128_hex('sum(' + _crc_of_hex('rh', 100) + ')')} AS checksum_hex FROM rec, crc_tab)
SELECT phase, n, checksum_hex FROM sums, (VALUES ('generate'), ('sort')) p(phase)"""

    q["two_level_sort"] = _records_sql(ORDER_RECORDS) + """
SELECT row_number() OVER (ORDER BY substr(s_hex, 1, 20)) AS rk, substr(s_hex, 1, 20) AS key_hex,
       """ + _value_hex('r', 's_hex') + """ AS value_hex
FROM states"""

    q["hsph_metric"] = """WITH log AS (
  SELECT user_id AS run, event_type AS phase,
         CAST(floor(epoch_us(min(ts)) / 1000000) AS BIGINT) AS start_s,
         CAST(floor(epoch_us(max(ts)) / 1000000) AS BIGINT) AS end_s,
         count(*) * 100 AS bytes, count(*) % 5 <> 0 AS good
  FROM events GROUP BY 1, 2),
per AS (SELECT run, max(end_s) - min(start_s) AS seconds, CAST(sum(bytes) AS BIGINT) AS bytes,
               bool_and(good) AS good FROM log GROUP BY run)
SELECT run, seconds, bytes,
  CAST(bytes // 1000000 AS DOUBLE) / 10000.0 AS sf,
  CAST((seconds * 10000) // 3600 AS DOUBLE) / 10000.0 AS hours,
  CASE WHEN (seconds * 10000) // 3600 > 0 AND good
       THEN CAST((bytes // 1000000) * 10000 // ((seconds * 10000) // 3600) AS DOUBLE) / 10000.0 END AS metric
FROM per"""
    return q
