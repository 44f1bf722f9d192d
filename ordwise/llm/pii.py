"""Personal data: patterns propose spans, checksums confirm them, context adjusts a score.

Built from SQL functions only. Every expression works on one row, so a scan has
no shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordwise.llm import spans as S
from ordwise.llm.common import text_of

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["iban", "id_number", "short_card"]
KINDS = BASE_KINDS + ADDED_KINDS

#: Patterns that find the contract's base matches and the added kinds (short cards are looked
#: for among the card matches). Repetitions that can never give back a
#: character are possessive, and a run is entered at its first character only (or right
#: after a match), so time is linear even on very long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])",
    "id_number": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}

#: Score of a confirmed pattern before its context is read, and what a context word adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "id_number": 0.4,
          "short_card": 0.4}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|address|host|server",
    "card": "card|visa|credit|payment|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "id_number": "ssn|social|security|insurance|id",
    "short_card": "card|visa|credit|amex|payment|karte|carte|tarjeta",
}
CONTEXT_CHARS = 40
CONTEXT_GAIN = 0.3
#: Spans of the added kinds are reported from this score on; base spans always are.
MIN_SCORE = 0.65


def luhn(value: str) -> str:
    """Whether the digits of ``value`` pass the Luhn check: from the right, every second
    digit is doubled (and 9 taken off above 9), which is one translate."""
    each = ("transform(split(reverse(regexp_replace(" + value + ", '[^0-9]', '')), ''), (x, i) -> "
            "coalesce(try_cast(CASE WHEN i % 2 = 1 THEN translate(x, '0123456789', '0246813579') "
            "ELSE x END AS bigint), 0L))")
    return f"{S.total(each)} % 10 = 0"


def mod97(value: str) -> str:
    """Whether an account number passes the mod-97 check: letters stand for 10 to 35, the
    first four characters go to the end, and the remainder is 1."""
    v = f"upper(translate({value}, ' ', ''))"
    each = (f"filter(transform(split(concat(substring({v}, 5), substring({v}, 1, 4)), ''), c -> CASE WHEN "
            "c RLIKE '[A-Z]' THEN ascii(c) - 55 ELSE try_cast(c AS int) END), x -> x IS NOT NULL)")
    return (f"aggregate({each}, 0, (acc, x) -> CASE WHEN x > 9 THEN (acc * 100 + x) % 97 "
            "ELSE (acc * 10 + x) % 97 END) = 1")


def _n_digits(lo: int, hi: int) -> str:
    return f"length(regexp_replace(m.value, '[^0-9]', '')) BETWEEN {lo} AND {hi}"


#: Checks on a proposed match m. Parts of an ip are at most 255, leading zeros apart.
VALID = {
    "email": "true",
    "ip": "forall(split(m.value, r'\\.'), p -> length(ltrim('0', p)) <= 3 "
          "AND cast(right(p, 3) AS int) <= 255)",
    "card": f"{_n_digits(16, 19)} AND {luhn('m.value')}",
    "phone": _n_digits(8, 15),
    "iban": mod97("m.value"),
    "id_number": "NOT m.value RLIKE '^(000|666|9)|-00-|-0000$'",
    "short_card": f"{_n_digits(13, 15)} AND {luhn('m.value')}",
}
#: Kinds that are looked for among another kind's matches.
MATCHES = {"short_card": "card"}
_PRESENT = {"email": "contains(__text, '@')", "phone": "contains(__text, '+')"}


def _scored(kind: str) -> str:
    """The spans of a kind with a score: the pattern's, and more if a context word is near."""
    c = CONTEXT_CHARS
    near = (f"lower(concat_ws(' ', {S.window('c', f'greatest(0L, s.start - {c})', f'least({c}L, s.start)')}, "
            f"{S.window('c', 's.end', str(c))}))")
    score = (f"least(1.0D, {SCORES[kind]}D + CASE WHEN {near} RLIKE r'(^|[^a-z0-9_])(?:{CONTEXT[kind]})' "
             f"THEN {CONTEXT_GAIN}D ELSE 0.0D END)")
    scored = (f"transform(__s_{kind}, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, "
              f"'score', round({score}, 2)))")
    return S.let("__pieces", "c", scored)


def _with_spans(df: DataFrame) -> DataFrame:
    """Adds __s_<kind>, __base and __added to rows with a ``__text``."""
    def add(df, **columns):
        return df.select("*", *[F.expr(x).alias(n) for n, x in columns.items()])

    df = add(df, **{f"__m_{k}": S.found("__text", PATTERNS[k], _PRESENT.get(k, "true"))
                    for k in PATTERNS})
    df = add(df, **{f"__s_{k}": S.as_spans(f"__m_{MATCHES.get(k, k)}", k, VALID[k]) for k in KINDS})
    some = " OR ".join(f"size(__s_{k}) > 0" for k in KINDS)
    df = add(df, __pieces=f"CASE WHEN {some} THEN {S.pieces('__text')} ELSE cast(array() AS array<string>) END")
    df = add(df, **{f"__r_{k}": _scored(k) for k in KINDS})
    df = add(df, __base="concat(" + ", ".join(f"__r_{k}" for k in BASE_KINDS) + ")",
             __more="concat(" + ", ".join(f"__r_{k}" for k in ADDED_KINDS) + ")")
    df = add(df, __likely=f"filter(__more, s -> s.score >= {MIN_SCORE})")
    return add(df, __added=S.by_kind(S.apart("__likely", "__base"), KINDS))


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts per base kind, base_sha256, spans, span_list.

    ``span_list`` holds (kind, start, end, score) in code points. The base kinds
    follow the contract exactly; added spans (account numbers by mod-97, and
    number shapes that need a context word) never overlap a base span. Null text
    counts as empty (no spans: the hash of the empty string); a null doc_id and
    repeated rows are kept; an empty table gives no rows.
    """
    f = _with_spans(docs.select("doc_id", text_of().alias("__text")))
    return f.select(
        "doc_id", *[F.expr(f"cast(size(__r_{k}) AS bigint)").alias(f"n_{k}") for k in BASE_KINDS],
        F.expr(f"sha2({S.joined('__base')}, 256)").alias("base_sha256"),
        F.expr(S.joined("concat(__base, __added)")).alias("spans"),
        F.expr("concat(__base, __added)").alias("span_list"))


def redact_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets, all columns kept.

    Rows without personal data are unchanged; where text changes, ``n_chars`` (if
    there is one) becomes its new length.
    """
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), text_of().alias("__text"))
    f = _with_spans(row)
    f = f.select("__row", "__text", F.expr(S.by_start("concat(__base, __added)", KINDS)).alias("__all"))
    f = f.select("__row", "__all", F.expr(S.masked("__text", "__all")).alias("__new"))
    hit = F.size("__all") > 0

    def out(field) -> Column:
        old = F.col("__row")[field.name]
        if field.name == "text":
            return F.when(hit, F.col("__new")).otherwise(old).alias(field.name)
        if field.name == "n_chars":
            return F.when(hit, F.length("__new").cast(field.dataType)).otherwise(old).alias(field.name)
        return old.alias(field.name)

    return f.select(*[out(x) for x in docs.schema.fields])
