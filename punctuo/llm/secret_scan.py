"""Secret scan with a trigram index in front of the regular expressions.

Each rule's regex is parsed once on the driver into a Boolean trigram query:
the trigrams any match must contain, joined by AND along a sequence and by OR
over alternatives. The index holds, for every document, which of the rules'
trigrams its lower-cased text contains (the postings, stored with the row, so
that intersecting them moves no data). A rule's query is evaluated on these
postings and only candidates run the regex; a rule without mandatory trigrams
(hexadecimal runs) scans every text. All of it is built-in Spark functions.

Match places come from the same regex: the pieces between matches and the
matches alternate, so a running sum of their lengths gives the code points.

Defined results: null text is an empty text without spans; empty, repeated and
very long texts are scanned whole; other columns pass through untouched and may
have any name; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as K
from re import _parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``regex`` finds spans; matches whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    base: bool = False


# The three base kinds, then formats that issuers have published. A run of the access and hex kinds is
# matched whole or not at all, so their least lengths stand in the regex itself.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(sk|rk)_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)

# ---------------------------------------------------------------- regex -> Boolean trigram query
# A query is None (anything may match), a trigram, or (op, [queries]) with op "and" or "or".
MOST = 128


def _join(op: str, parts: list):
    if op == "or" and any(p is None for p in parts):
        return None
    parts = [p for p in dict.fromkeys(map(_frozen, parts)) if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else (op, tuple(parts))


def _frozen(q):
    return q if q is None or isinstance(q, str) else (q[0], tuple(q[1]))


def _of_strings(strings: set[str]):
    """Any of ``strings`` must occur; one that holds another of them adds nothing."""
    strings = {s for s in strings if not any(t != s and t in s for t in strings)}
    if any(len(s) < 3 for s in strings):
        return None
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _strings(item) -> set[str] | None:
    """All texts the item can match (lower case), or None if they are many."""
    op, arg = item
    if op is K.LITERAL:
        return {chr(arg).lower()}
    if op is K.IN and all(o is K.LITERAL for o, _ in arg) and len(arg) <= 8:
        return {chr(c).lower() for _, c in arg}
    if op is K.SUBPATTERN:
        return _all(arg[3])
    if op is K.BRANCH:
        sets = [_all(b) for b in arg[1]]
        return None if None in sets else set().union(*sets)
    if op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[1] <= 4:
        one, out = _all(arg[2]), set()
        if one is None:
            return None
        for n in range(arg[0], arg[1] + 1):
            out |= reduce(lambda a, _: {x + y for x in a for y in one}, range(n), {""})
        return out if len(out) <= MOST else None
    if op is K.AT:
        return {""}
    return None


def _all(items) -> set[str] | None:
    out = {""}
    for item in items:
        s = _strings(item)
        if s is None or len(out) * len(s) > MOST:
            return None
        out = {x + y for x in out for y in s}
    return out


def _query(items):
    """What any match of the sequence must contain."""
    parts, run = [], {""}
    for item in items:
        s = _strings(item)
        if s is not None and len(run) * len(s) <= MOST:
            run = {x + y for x in run for y in s}
            continue
        parts.append(_of_strings(run))
        run = {""}
        op, arg = item
        if op is K.SUBPATTERN:
            parts.append(_query(arg[3]))
        elif op is K.BRANCH:
            parts.append(_join("or", [_query(b) for b in arg[1]]))
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] > 0:
            parts.append(_query(arg[2]))
    parts.append(_of_strings(run))
    return _join("and", parts)


def trigram_query(regex: str):
    """The Boolean trigram query of ``regex``; None if no trigram is mandatory."""
    return _query(P.parse(regex))


def trigrams_of(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def _holds(query, present: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(present, query)
    parts = [_holds(q, present) for q in query[1]]
    return reduce((lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b), parts)


# ---------------------------------------------------------------- the scan
def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _spans(rule: Rule, order: int, text: Column) -> Column:
    """Spans of one rule: array of (start, order, end, kind), code points, end exclusive."""
    regex = F.lit(rule.regex)
    parts = F.arrays_zip(F.transform(F.split(text, rule.regex, -1), F.length).alias("gap"),
                         F.transform(F.regexp_extract_all(text, regex, F.lit(0)), F.length).alias("hit"),
                         F.transform(F.regexp_extract_all(text, regex, F.lit(rule.group)), F.length).alias("val"))
    span = lambda a, p: F.struct((a["at"] + p["gap"]).alias("start"), F.lit(order).alias("order"),
                                 (a["at"] + p["gap"] + p["hit"]).alias("end"), F.lit(rule.kind).alias("kind"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    first = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    step = lambda a, p: F.struct(
        (a["at"] + p["gap"] + F.coalesce(p["hit"], F.lit(0))).alias("at"),
        F.when(p["val"] >= rule.least, F.concat(a["spans"], F.array(span(a, p)))).otherwise(a["spans"]).alias("spans"))
    return F.aggregate(parts, first, step, lambda a: a["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", out: str = "secret_spans") -> DataFrame:
    """``docs`` with one more column ``out``: array of (start, order, end, kind), sorted."""
    queries = [trigram_query(r.regex) for r in rules]
    grams = sorted(set().union(*map(trigrams_of, queries)))
    text, present = fresh(docs, "scan_text"), fresh(docs, "scan_grams")
    df = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    index = F.array(*[F.lit(g) for g in grams]) if grams else F.array().cast("array<string>")
    # the one-element array binds the lower-cased text, which is made once and not once per trigram
    df = df.withColumn(present, F.transform(F.array(F.lower(F.col(text))), lambda low: F.filter(index, lambda g: F.contains(low, g)))[0])
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    found = [_spans(r, i, F.col(text)) if q is None else
             F.when(_holds(q, F.col(present)), _spans(r, i, F.col(text))).otherwise(none)
             for i, (r, q) in enumerate(zip(rules, queries, strict=True))]
    # a rule that scans fully still skips the span arithmetic where nothing matches
    found = [F.when(F.col(text).rlike(r.regex), f).otherwise(none) if q is None else f
             for f, r, q in zip(found, rules, queries, strict=True)]
    return df.withColumn(out, F.array_sort(F.concat(*found))).drop(text, present)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mask``; all columns stay.

    Null texts stay null."""
    spans = fresh(docs, "scan_spans")
    df = scan(docs, rules, text_col, spans)
    text = F.col(text_col)
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    step = lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] >= a["at"], F.concat(a["parts"], F.array(text.substr(a["at"] + 1, s["start"] - a["at"]), F.lit(mask))))
        .otherwise(a["parts"]).alias("parts"))
    rest = lambda a: F.concat(F.array_join(a["parts"], ""), text.substr(a["at"] + 1, F.length(text)))
    clean = F.when(F.size(F.col(spans)) == 0, text).otherwise(F.aggregate(F.col(spans), first, step, rest))
    return df.withColumn(text_col, F.when(text.isNotNull(), clean)).drop(spans).select(*[F.col(f"`{c}`") for c in docs.columns])
