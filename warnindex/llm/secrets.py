"""Secret scans with DataFrame / SQL functions only (no Python on the data path).

Pattern kinds (``assign``, ``access``, ``hex``) are regular expressions; a kind's
matches are found leftmost and non-overlapping, then those that are too short
are dropped.  Offsets come from the text between the matches: ``split`` and
``regexp_extract_all`` on the same pattern interleave to the whole text, so
running sums of their lengths (code points) give every start and end.

Entropy kinds scan candidate strings, one character class each.  A window of
fixed width slides over the candidate; entering and leaving characters change
the counts and the sum of c*log2(c) incrementally, so a step costs the same for any
width.  From the first to the last window at or above the class's threshold the
characters become a span, unless an allow-list rule holds for that span from end to end
(alphabets in order, published example keys, one unit repeated, words between
slashes).  What stands beside it in the candidate (a folder, dashes) does not count,
so a key after such text is found.  The allow-list never removes spans of the pattern kinds.

Every row is scanned on its own, whole; nothing is shuffled.

Defined results: null text counts as empty; no match gives counts of 0 and the
empty string; repeated rows and null ids are scanned like any other; extra
columns are kept by ``scan`` and ``redact``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warnindex.llm.common import fresh_name

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
SPAN = "array<struct<start:bigint,rank:int,kind:string,stop:bigint>>"


@dataclass(frozen=True)
class Pattern:
    kind: str
    regex: str
    group: int = 0
    shortest: int = 1  # of the group


# An over-long greedy run equals the longest one, so a minimum can stand in the
# pattern where the whole match is the group; ``assign`` must match first, then drop.
PATTERNS = (
    Pattern("assign", ASSIGN, 2, 12),
    Pattern("access", r"AKIA[A-Z0-9]{14,}"),
    Pattern("hex", r"[0-9a-f]{16,}"),
)


@dataclass(frozen=True)
class EntropyClass:
    kind: str
    alphabet: str
    window: int
    threshold: float  # bits per character

    @property
    def regex(self) -> str:
        chars = "".join("\\" + c if c in "-]^\\/" else c for c in self.alphabet)
        return f"(?<![{chars}])[{chars}]{{{self.window},}}"


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    EntropyClass("entropy_hex", _DIGITS + "abcdefABCDEF", 20, 3.0),
    EntropyClass("entropy_base64", _DIGITS + _LOWER + _LOWER.upper() + "+/_-", 24, 4.0),
)
# Allow-list: what a span as a whole may be without being a secret.
EXAMPLE = r"(?i)(?:example|sample|dummy|placeholder|changeme)(?:key|token|secret)?$"  # published example keys end so
RUNS = "abcdefghijklmnopqrstuvwxyz|0123456789|abcdef|[+/_-]"  # nothing but alphabets in order
WORD, WORD_LENGTH = "[A-Z]?[a-z]+|[A-Z]+", 3.5  # words between / _ -, long ones on average
UNIT = 10  # a unit of as many characters at most, repeated from end to end
ALLOW = (
    f"x rlike '{EXAMPLE}'",
    f"regexp_replace(lower(x), '{RUNS}', '') = ''",
    f"x rlike '[/_-]' and not (x rlike '[0-9+]') and size(regexp_extract_all(x, '{WORD}', 0)) * {WORD_LENGTH}D <= length(x)",
    f"exists(sequence(1, {UNIT}), k -> 2 * k <= length(x) and substring(x, k + 1) = substring(x, 1, length(x) - k))",
)


def _q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _scan_sum(arr: str) -> str:
    """Exclusive running sums of a bigint array."""
    return (f"aggregate({arr}, named_struct('s', 0L, 'o', cast(array() as array<bigint>)), "
            "(acc, v) -> named_struct('s', acc.s + v, 'o', array_append(acc.o, acc.s)), acc -> acc.o)")


def running_sums(arr: str, block: int = 512) -> str:
    """Exclusive running sums in two levels: near-linear also for very many matches."""
    per = f"transform(sequence(0, cast((size(vs) - 1) / {block} as int)), b -> slice(vs, b * {block} + 1, {block}))"
    sums = "transform(parts, q -> aggregate(q, 0L, (s, v) -> s + v))"
    join = f"flatten(transform(arrays_zip(parts, offs), z -> transform({_scan_sum('z.parts')}, v -> v + z.offs)))"
    inner = _let(_scan_sum(sums), "offs", join)
    return _let(arr, "vs", f"if(size(vs) = 0, cast(array() as array<bigint>), {_let(per, 'parts', inner)})")


def _located(text: str, regex: str, group: int = 0) -> str:
    """Array of (start, stop, m, g) of all matches in a text, in order."""
    m, parts = f"regexp_extract_all({text}, {_q(regex)}, 0)", f"split({text}, {_q(regex)}, -1)"
    g = f"regexp_extract_all({text}, {_q(regex)}, {group})" if group else "m"
    lens = "zip_with(m, slice(p, 1, size(m)), (x, y) -> cast(length(x) + length(y) as bigint))"
    starts = f"zip_with({running_sums(lens)}, slice(p, 1, size(m)), (x, y) -> x + length(y))"
    rows = f"zip_with(zip_with(m, {g}, (x, y) -> named_struct('m', x, 'g', y)), {starts}, " \
           "(x, s) -> named_struct('start', s, 'stop', s + length(x.m), 'm', x.m, 'g', x.g))"
    return _let(m, "m", _let(parts, "p", rows))


_NONE = f"cast(array() as {SPAN})"


def pattern_spans(text: str, p: Pattern, rank: int) -> str:
    found = _located(text, p.regex, p.group)
    kept = f"filter({found}, z -> length(z.g) >= {p.shortest})"
    spans = f"transform({kept}, z -> named_struct('start', z.start, 'rank', {rank}, 'kind', {_q(p.kind)}, 'stop', z.stop))"
    return f"if({text} rlike {_q(p.regex)}, {spans}, {_NONE})"


def entropy_extent(word: str, c: EntropyClass) -> str:
    """(first, last): 0-based ends of the first and last window at or above the
    threshold, or nulls.  ``word`` holds characters of the class only."""
    w = c.window
    most = w * (math.log2(w) - c.threshold) + 1e-9  # sum of n*log2(n) over a window that passes
    logs = "array(" + ", ".join(repr(n * math.log2(n)) + "D" if n else "0.0D" for n in range(w + 2)) + ")"
    zero = f"named_struct('n', array_repeat(0, {len(c.alphabet)}), 's', 0.0D, 'first', cast(null as int), 'last', cast(null as int))"
    came, went = "a[i]", f"if(i >= {w}, a[greatest(i - {w}, 0)], -1)"
    grow = "f[st.n[io.i] + 1] - f[st.n[io.i]]"
    shrink = "if(io.o < 0, 0.0D, f[st.n[greatest(io.o, 0)] - 1] - f[st.n[greatest(io.o, 0)]])"
    s = f"if(io.i = io.o, st.s, st.s + {grow} + {shrink})"
    counts = "transform(st.n, (v, k) -> v + if(k = io.i, 1, 0) - if(k = io.o, 1, 0))"
    hit = f"i >= {w - 1} and ns <= {most!r}D"
    step = _let(f"named_struct('i', {came}, 'o', {went})", "io", _let(
        s, "ns", f"named_struct('n', {counts}, 's', ns, 'first', if(st.first is null and {hit}, i, st.first), 'last', if({hit}, i, st.last))"))
    fold = f"aggregate(sequence(0, size(a) - 1), {zero}, (st, i) -> {step}, st -> named_struct('first', st.first, 'last', st.last))"
    chars = f"transform(split({word}, ''), ch -> locate(ch, {_q(c.alphabet)}) - 1)"
    return _let(logs, "f", _let(f"filter({chars}, k -> k >= 0)", "a", fold))


def entropy_spans(text: str, c: EntropyClass, rank: int, allow: tuple[str, ...]) -> str:
    """Spans of a class; ``allow``: SQL conditions on a span's text ``x``."""
    found = _located(text, c.regex)
    # fewer different characters than 2 ** threshold cannot reach it in any window
    rich = f"filter({found}, z -> size(array_distinct(split(z.m, ''))) >= {math.ceil(2 ** c.threshold - 1e-6)})"
    ext = f"transform({rich}, z -> named_struct('start', z.start, 'm', z.m, 'e', {entropy_extent('z.m', c)}))"
    part = f"substring(z.m, z.e.first - {c.window - 2}, z.e.last - z.e.first + {c.window})"
    known = _let(part, "x", " or ".join(f"({a})" for a in allow)) if allow else "false"
    spans = (f"transform(filter(filter({ext}, z -> z.e.first is not null), z -> not {known}), z -> named_struct('start', z.start + z.e.first - {c.window - 1}, "
             f"'rank', {rank}, 'kind', {_q(c.kind)}, 'stop', z.start + z.e.last + 1))")
    return f"if({text} rlike {_q(c.regex)}, {spans}, {_NONE})"


def scan(docs: DataFrame, text_col: str = "text", patterns: tuple[Pattern, ...] = PATTERNS,
         classes: tuple[EntropyClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW,
         base: str | None = None, added: str | None = None) -> DataFrame:
    """``docs`` with two arrays of (start, rank, kind, stop): code points, stop exclusive,
    ordered by start, then by the order in which the kinds are listed.  They are called ``base_spans`` and
    ``entropy_spans``, prefixed by ``_`` where ``docs`` has such columns."""
    base, added = base or fresh_name(docs, "base_spans"), added or fresh_name(docs, "entropy_spans")
    t = fresh_name(docs, "_scanned")
    out = docs.withColumn(t, F.coalesce(F.col(text_col), F.lit("")))
    first = [f"cast({pattern_spans(f'`{t}`', p, i)} as {SPAN})" for i, p in enumerate(patterns)]
    more = [f"cast({entropy_spans(f'`{t}`', c, len(patterns) + i, allow)} as {SPAN})" for i, c in enumerate(classes)]
    out = out.withColumn(base, F.expr(f"array_sort(concat({', '.join(first or [_NONE])}))"))
    return out.withColumn(added, F.expr(f"array_sort(concat({', '.join(more or [_NONE])}))")).drop(t)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping spans by one);
    ``chars_col``, where there is one, becomes the new length.  Null text stays null."""
    base = fresh_name(docs, "base_spans")
    more = fresh_name(docs, "entropy_spans")
    both = fresh_name(docs, "all_spans")
    d = scan(docs, text_col, base=base, added=more)
    d = d.withColumn(both, F.array_sort(F.concat(base, more)))
    t = f"`{text_col}`"
    fold = (f"aggregate(`{both}`, named_struct('at', 0L, 'out', cast('' as string)), (a, s) -> if(s.stop <= a.at, a, named_struct('at', s.stop, 'out', "
            f"concat(a.out, if(s.start >= a.at, concat(substring({t}, cast(a.at + 1 as int), cast(s.start - a.at as int)), {_q(mark)}), '')))), "
            f"a -> concat(a.out, substring({t}, cast(a.at + 1 as int))))")
    found = F.size(both) > 0
    cols = [F.when(found, F.expr(fold)).otherwise(F.col(text_col)).alias(text_col) if c == text_col else F.col(c) for c in docs.columns]
    out = d.select(*cols, F.col(both))
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.when(F.size(both) > 0, F.length(text_col).cast(kind)).otherwise(F.col(chars_col)))
    return out.select(docs.columns)
