"""Positions of regular-expression matches as SQL expressions, without Python code.

Every function returns the text of a Spark SQL expression over one row: no
shuffle, and time near linear (n log n) in text and matches. Offsets are
code points, ends are exclusive.
"""

from __future__ import annotations


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once.

    A plain column that is read inside a lambda may be computed again for every
    element; a lambda variable is not.
    """
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def total(values: str) -> str:
    return f"aggregate({values}, 0L, (acc, x) -> acc + x)"


def scanned(values: str, first: str, op: str) -> str:
    """Inclusive running results of ``op`` (an expression of x and y, with ``first`` as its neutral
    element) over an array: every step joins each value with the one 1, 2, 4, ... places
    before it, so n values cost about n * log2(n) operations."""
    moved = f"concat(array_repeat({first}, shiftleft(1, k)), slice(acc, 1, size(acc) - shiftleft(1, k)))"
    step = f"zip_with({moved}, acc, (x, y) -> {op})"
    bits = "sequence(0, cast(ceil(log2(size(v))) as int) - 1)"
    return let(values, "v", f"CASE WHEN size(v) > 1 THEN aggregate({bits}, v, (acc, k) -> {step}) ELSE v END")


def running(values: str) -> str:
    """Exclusive running sums of a non-empty array of longs."""
    return let(values, "w", f"zip_with({scanned('w', '0L', 'x + y')}, w, (x, y) -> x - y)")


def before(values: str, first: str, op: str) -> str:
    """Exclusive running results: ``first``, then those up to the place before."""
    return let(scanned(values, first, op), "s", f"slice(concat(array({first}), s), 1, size(s))")


#: Code points in a piece of a text.
PIECE = 256


def pieces(text: str) -> str:
    """The text as an array of pieces of ``PIECE`` code points. A substring of a long text is
    counted from its first byte on; one of its pieces is not."""
    return f"regexp_extract_all({text}, r'(?s).{{1,{PIECE}}}', 0)"


def window(parts: str, start: str, size: str) -> str:
    """Up to ``size`` (at most ``PIECE``) code points from 0-based ``start`` on."""
    two = " || ".join(f"coalesce(get({parts}, cast(({start}) div {PIECE} as int) + {i}), '')" for i in (0, 1))
    return f"substring({two}, cast(({start}) % {PIECE} as int) + 1, cast({size} as int))"


def between(parts: str, start: str, end: str) -> str:
    """The code points from ``start`` to ``end`` (exclusive), in time linear in their number."""
    a, z = f"cast(({start}) div {PIECE} as int)", f"cast((({end}) - 1) div {PIECE} as int)"
    head = f"substring(get({parts}, {a}), cast(({start}) % {PIECE} as int) + 1)"
    tail = f"substring(get({parts}, {z}), 1, cast((({end}) - 1) % {PIECE} as int) + 1)"
    return (f"CASE WHEN ({end}) <= ({start}) THEN '' WHEN {a} = {z} THEN {window(parts, start, f'({end}) - ({start})')} "
            f"ELSE concat({head}, array_join(slice({parts}, {a} + 2, {z} - {a} - 1), ''), {tail}) END")


def literal(pattern: str) -> str:
    """A raw SQL string; a pattern writes an apostrophe as \\x27."""
    if "'" in pattern:
        raise ValueError("write an apostrophe as \\x27")
    return f"r'{pattern}'"


def found(text: str, pattern: str, present: str = "true") -> str:
    """array<struct<start, value>> of the leftmost non-overlapping matches of ``pattern``.

    ``present`` is a cheap necessary condition; rows without it are not matched.
    """
    p = literal(pattern)
    # gap 0, match 0, gap 1, match 1, ...: a match starts after its gap and all before it
    steps = "zip_with(h, slice(g, 1, size(h)), (x, y) -> y + length(x))"
    placed = (f"zip_with(zip_with({running(steps)}, slice(g, 1, size(h)), (x, y) -> x + y), h, "
              "(x, y) -> named_struct('start', x, 'value', y))")
    gaps = f"transform(split({text}, {p}, -1), x -> cast(length(x) as bigint))"
    rows = let(f"regexp_extract_all({text}, {p}, 0)", "h", let(gaps, "g", placed))
    return (f"CASE WHEN {present} AND {text} RLIKE {p} THEN {rows} "
            "ELSE cast(array() as array<struct<start:bigint,value:string>>) END")


def as_spans(matches: str, kind: str, valid: str) -> str:
    """Matches whose ``value`` (written m.value in ``valid``) is valid, as spans of ``kind``."""
    return (f"transform(filter({matches}, m -> {valid}), m -> named_struct('kind', '{kind}', "
            "'start', m.start, 'end', m.start + length(m.value)))")


def joined(spans: str) -> str:
    """kind:start:end of every span in the given order, comma-joined."""
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def by_start(spans: str, kinds: list[str]) -> str:
    """Spans in order of start, then kind as listed, then end."""
    names = ", ".join(f"'{k}'" for k in kinds)
    return (f"transform(array_sort(transform({spans}, s -> named_struct('a', s.start, "
            f"'k', array_position(array({names}), s.kind), 'e', s.end, 's', s))), s -> s.s)")


def by_kind(spans: str, kinds: list[str]) -> str:
    """Spans in order of kind as listed, then start."""
    names = ", ".join(f"'{k}'" for k in kinds)
    return (f"transform(array_sort(transform({spans}, s -> named_struct("
            f"'k', array_position(array({names}), s.kind), 'a', s.start, 's', s))), s -> s.s)")


def apart(spans: str, others: str) -> str:
    """``spans`` that overlap none of ``others``, in order of start.

    Both are put in order of start: an overlap shows in the furthest end of the others
    before a span, or in the nearest start of those after it.
    """
    far = "9223372036854775807L"
    tag = lambda rows, own: (f"transform({rows}, s -> named_struct('a', s.start, 'z', s.end, 'own', {own}, "  # noqa: E731
                             f"'s', CASE WHEN {own} THEN s END))")
    ends = before("transform(o, x -> CASE WHEN x.own THEN 0L ELSE x.z END)", "0L", "greatest(x, y)")
    starts = let(f"transform(reverse(o), x -> CASE WHEN x.own THEN {far} ELSE x.a END)", "r",
                 f"reverse({before('r', far, 'least(x, y)')})")
    clear = ("transform(filter(zip_with(zip_with(o, pe, (x, p) -> named_struct('x', x, 'p', p)), ns, "
             "(y, n) -> CASE WHEN y.x.own AND y.p <= y.x.a AND n >= y.x.z THEN y.x.s END), s -> s IS NOT NULL), s -> s)")
    work = let(f"array_sort(concat({tag(spans, 'true')}, {tag(others, 'false')}), (l, r) -> CASE WHEN l.a < r.a THEN -1 "
               "WHEN l.a > r.a THEN 1 ELSE 0 END)", "o", let(ends, "pe", let(starts, "ns", clear)))
    return f"CASE WHEN size({spans}) > 0 AND size({others}) > 0 THEN {work} ELSE {spans} END"


def masked(text: str, spans: str) -> str:
    """``text`` with every maximal run of overlapping spans replaced by its kind in brackets.

    ``spans`` are in order of start; a run takes the kind of its first span. A span begins a
    run if no span before it reaches beyond its start; what lies between two runs is
    taken from the text's pieces.
    """
    ends = before("transform(sp, s -> s.end)", "0L", "greatest(x, y)")
    heads = ("filter(zip_with(sp, pe, (s, p) -> named_struct('kind', s.kind, 'start', s.start, 'before', p)), "
             "r -> r.start >= r.before)")
    body = f"array_join(transform({heads}, r -> concat({between('parts', 'r.before', 'r.start')}, '[', upper(r.kind), ']')), '')"
    last = let("array_max(transform(sp, s -> s.end))", "z",
               f"substring(get(parts, cast(z div {PIECE} as int)), cast(z % {PIECE} as int) + 1) || "
               f"array_join(slice(parts, cast(z div {PIECE} as int) + 2, size(parts)), '')")
    rebuilt = let(spans, "sp", let(pieces(text), "parts", let(ends, "pe", f"concat({body}, coalesce({last}, ''))")))
    return f"CASE WHEN size({spans}) > 0 THEN {rebuilt} ELSE {text} END"
