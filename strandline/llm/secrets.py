"""Secrets in texts: fixed patterns, and tokens that only a random source explains.

All on DataFrame functions. ``scan`` finds the fixed patterns and the candidate tokens of each
text inside its row. Three tests ask whether a token's symbols look drawn at random from the
smallest alphabet that holds it: chi-squared uniformity, runs of character classes (where there are
several), and serial correlation. ``discoveries`` then controls false discoveries: under the hypothesis "ordinary
token" the class of character changes, and letters of one case follow each other in pairs that are no ``PAIRS``, at
the corpus's own rates. Twice the lesser of both p-values counts; Benjamini-Hochberg is applied
within each stratum of encoding and length, to p-values rounded up to tenths of a decade, which needs only
counts per stratum and decade. Tokens of digits alone have neither changes nor pairs and are never found.

Work is linear in a text's matches but for sorting: positions and reaches are running totals by blocks, overlaps are found by halving, and a
redacted text is joined from pieces once.

Null texts count as empty and have no spans. Rows are independent, so repeated rows repeat.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed patterns: (kind, pattern, what a match needs besides).
KEYWORDS = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"  # the same spans as AKIA[A-Z0-9]+ of 16 characters or more
HEX = "[0-9a-f]{32,}"
MIN_TOKEN = 20
TOKEN = "[A-Za-z0-9+/_=-]{{{least},}}"
_AZ, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Inferred encodings, smaller alphabets first: (name, pattern of the whole token, its alphabet in order).
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("letters", "^[a-z]+$", _AZ),
    ("LETTERS", "^[A-Z]+$", _AZ.upper()),
    ("base32", "^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base32-lower", "^[a-z2-7]+=*$", "abcdefghijklmnopqrstuvwxyz234567"),
    ("base36", "^[a-z0-9]+$", _AZ + _DIGITS),
    ("BASE36", "^[A-Z0-9]+$", _AZ.upper() + _DIGITS),
    ("Letters", "^[A-Za-z]+$", _AZ.upper() + _AZ),
    ("base62", "^[A-Za-z0-9]+$", _AZ.upper() + _AZ + _DIGITS),
    ("base64", "^[A-Za-z0-9+/_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
ONE_CASE = ("letters", "LETTERS")
#: Pairs of letters that make up most of English, French, German and Spanish words.
PAIRS = (
    "th he in er an re on en at es or te st nd ed ti of it al ar to is ic ou nt as io le ng ve co me de hi ri ro li ra ne ea se ce om ma el ta be"
    " ch ha ll ur la ge et di na ns si us ec ac un lo ut tr ie ei sc ss wh sh no ly ho ul ad po ni pe mi ca wi wa fo im em il ol os sp su pr do am"
    " id ir ot uc pl ai ev ig ke ck tt ee ia ld rs pa ow ru wo ts ab ue ui qu au eu eb ag ef ff br gr cr fr bl cl cu cc fi fe ft ry rt rd rm nc nn"
    " mp mo nz zu tz pf sa so ga gi iv ye lt ls ht ep ap op ob ub rr ux zw hr hs"
).split()
LENGTH_STEPS = (24, 32, 48, 64, 96, 128)
RANDOM_P = 0.001
FDR = 0.01
MIN_RATE = 0.05
KINDS = ("assign", "access", "hex", "random")
MAX_DECADES = 400
BLOCK, PIECE = 256, 4096


def _running(count: str, value: str, merge: Callable[[str, str], str]) -> str:
    """SQL for the totals of ``value`` (of the lambda variable i) before each i below ``count``, which is 1 at least.

    An array that grows by one is copied each time; so it grows to ``BLOCK`` only, and once more over the blocks.
    """
    last = f"(least({count}, (b + 1) * {BLOCK}) - 1)"
    totals = f"transform(sequence(0, ({count} - 1) div {BLOCK}), b -> aggregate(sequence(b * {BLOCK}, {last}), 0, (a, i) -> {merge('a', value)}))"
    grown = "aggregate({items}, named_struct('at', {start}, 'out', cast(array() AS array<int>)), (a, i) -> named_struct('at', {next}, 'out', array_append(a.out, a.at)), a -> a.out)"
    blocks = grown.format(items=totals, start="0", next=merge("a.at", "i"))
    return f"flatten(transform({blocks}, (s, b) -> {grown.format(items=f'sequence(b * {BLOCK}, {last})', start='s', next=merge('a.at', value))}))"


def _spans(pattern: str, group: int | None = None, least: int = 0) -> Column:
    """Spans of leftmost non-overlapping matches, from the texts between and in the matches."""
    quoted = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    # one struct with the texts between (g) and of (m) the matches and of the group (v), bound by a one-element array, so that the text is matched once
    value = f", 'v', regexp_extract_all(body, {quoted}, {group})" if group is not None else ""
    bound = f"array(named_struct('g', split(body, {quoted}, -1), 'm', regexp_extract_all(body, {quoted}, 0){value}))"
    before = _running("size(q.m)", "length(get(q.g, i)) + length(get(q.m, i))", "{} + {}".format)
    begin, length = "s + length(get(q.g, i))", "length(get(q.m, i))"
    ok = f"length(get(q.{'v' if group is not None else 'm'}, i)) >= {least}"
    body = f"transform({before}, (s, i) -> named_struct('start', {begin}, 'end', {begin} + {length}, 'value', get(q.m, i), 'ok', {ok}))"
    return F.expr(f"CASE WHEN body RLIKE {quoted} THEN filter(get(transform({bound}, q -> {body}), 0), x -> x.ok) END")


def _meets(spans: str) -> str:
    """SQL whether the span t meets one of ``spans``, which are in order and do not overlap: the last one that begins before t's end tells."""
    halve = (
        f"CASE WHEN a.lo >= a.hi THEN a WHEN get({spans}, (a.lo + a.hi) div 2).start < t.end"
        " THEN named_struct('lo', cast((a.lo + a.hi) div 2 + 1 AS int), 'hi', a.hi) ELSE named_struct('lo', a.lo, 'hi', cast((a.lo + a.hi) div 2 AS int)) END"
    )
    begun = f"aggregate(sequence(1, length(bin(size({spans})))), named_struct('lo', 0, 'hi', size({spans})), (a, i) -> {halve}, a -> a.lo)"
    return f"(size({spans}) > 0 AND coalesce(get({spans}, {begun} - 1).end > t.start, false))"


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), min_token: int = MIN_TOKEN) -> DataFrame:
    """``keep`` columns, the text as ``body``, and arrays of (start, end, value): assign, access, hex, token.

    Positions are code points, ends exclusive. Tokens have ``min_token`` characters at least; those overlapping a fixed span are left out.
    """
    out = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("body"))
    out = out.select(
        "*",
        _spans(ASSIGN, 2, 8).alias("assign"),
        _spans(ACCESS).alias("access"),
        _spans(HEX).alias("hex"),
        _spans(TOKEN.format(least=min_token)).alias("token"),
    )
    none = "cast(array() AS array<struct<start:int,end:int,value:string,ok:boolean>>)"
    out = out.select(*keep, "body", *(F.expr(f"coalesce({c}, {none})").alias(c) for c in ("assign", "access", "hex", "token")))
    return out.withColumn("token", F.expr(f"filter(token, t -> NOT ({' OR '.join(map(_meets, KINDS[:3]))}))"))


def _normal_tail(z: str) -> str:
    """SQL for P(N(0,1) > z), z >= 0 (rational approximation 26.2.17 of Abramowitz and Stegun, error below 1e-7)."""
    t = f"(1D / (1D + 0.2316419D * {z}))"
    series = f"{t} * (0.319381530D + {t} * (-0.356563782D + {t} * (1.781477937D + {t} * (-1.821255978D + {t} * 1.330274429D))))"
    return f"(exp(-{z} * {z} / 2D) / {math.sqrt(2 * math.pi)!r}D * {series})"


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (with ``value``) plus encoding, n, changes of class, steps (those and unusual pairs of letters), and p_random.

    p_random is three times the least p-value of the three tests against a uniform source,
    at most 1. The chi-squared statistic is standardised by its exact mean and variance for
    n draws, since few tokens have five symbols per cell.
    """
    enc = "CASE " + " ".join(f"WHEN value RLIKE '{p}' THEN '{n}'" for n, p, _ in ENCODINGS) + " ELSE 'other' END"
    alphabet = "CASE encoding " + " ".join(f"WHEN '{n}' THEN '{a}'" for n, _, a in ENCODINGS) + f" ELSE '{ENCODINGS[-1][2]}' END"
    core = "translate(rtrim('=', value), '-_', '+/')"
    out = tokens.withColumn("encoding", F.expr(enc)).withColumn("alphabet", F.expr(alphabet))
    out = out.withColumn("code", F.expr(f"transform(filter(split({core}, ''), c -> c != ''), c -> instr(alphabet, c) - 1)"))
    out = out.withColumn("class", F.expr("transform(filter(split(value, ''), c -> c NOT IN ('', '=')), c -> CASE WHEN c RLIKE '[a-z]' THEN 0 WHEN c RLIKE '[A-Z]' THEN 1 WHEN c RLIKE '[0-9]' THEN 2 ELSE 3 END)"))
    # nothing but padding, or one symbol and padding, is no token
    out = out.withColumn("n", F.size("code")).withColumn("k", F.length("alphabet")).where("n > 1")
    out = out.withColumn("changes", F.expr("size(filter(sequence(1, n - 1), i -> get(class, i) != get(class, i - 1)))"))
    known = "".join("1" if a == b or a + b in PAIRS else "0" for a in _AZ for b in _AZ)
    out = out.withColumn("letter", F.expr("transform(split(lower(rtrim('=', value)), ''), c -> ascii(c) - 97)"))
    pair = f"get(class, i) <= 1 AND substring('{known}', 26 * get(letter, i - 1) + get(letter, i) + 1, 1) = '0'"
    out = out.withColumn("steps", F.expr(f"size(filter(sequence(1, n - 1), i -> get(class, i) != get(class, i - 1) OR ({pair})))"))
    # shares of classes in each alphabet, for the expected number of runs
    same = "CASE encoding " + " ".join(f"WHEN '{n}' THEN {_same_class(a)!r}D" for n, _, a in ENCODINGS) + f" ELSE {_same_class(ENCODINGS[-1][2])!r}D END"
    out = out.withColumn("same", F.expr(same))
    squares = "aggregate(array_distinct(code), 0L, (a, x) -> a + cast(pow(size(filter(code, y -> y = x)), 2) AS bigint))"
    out = out.withColumn("chi", F.expr(f"(k * {squares} / n - n - (k - 1)) / sqrt(2D * (k - 1) * (n - 1) / n)"))
    out = out.withColumn("runs", F.expr("coalesce((changes - (n - 1) * (1 - same)) / nullif(sqrt((n - 1) * same * (1 - same)), 0D), 0D)"))
    mean = "((k - 1) / 2D)"
    lagged = f"aggregate(sequence(1, n - 1), 0D, (a, i) -> a + (get(code, i) - {mean}) * (get(code, i - 1) - {mean}))"
    out = out.withColumn("serial", F.expr(f"{lagged} / ((k * k - 1) / 12D) / sqrt(n - 1)"))
    p_chi = f"CASE WHEN chi <= 0 THEN 1D ELSE {_normal_tail('chi')} END"
    two = lambda c: f"2 * {_normal_tail(f'abs({c})')}"
    out = out.withColumn("p_random", F.expr(f"least(1D, 3 * least({p_chi}, {two('runs')}, {two('serial')}))"))
    return out.drop("code", "class", "letter", "alphabet", "k", "same", "chi", "runs", "serial")


def _same_class(alphabet: str) -> float:
    sizes = [sum(map(t, alphabet)) for t in (str.islower, str.isupper, str.isdigit)]
    sizes.append(len(alphabet) - sum(sizes))
    return sum((s / len(alphabet)) ** 2 for s in sizes)


def discoveries(tested: DataFrame, fdr: float = FDR, random_p: float = RANDOM_P) -> DataFrame:
    """``tested`` plus ``secret``: a false-discovery-controlled rejection of "ordinary token" that looks random too."""
    one = F.col("encoding").isin(*ONE_CASE)
    # shares over all tokens, and the share that three of four one-case tokens stay under: secrets among them raise these, which only makes the test stricter
    rates = tested.agg(
        F.sum("changes") / F.sum(F.col("n") - 1),
        F.sum("steps") / F.sum(F.col("n") - 1),
        F.percentile_approx(F.when(one, F.col("steps") / (F.col("n") - 1)), 0.75),
    ).collect()[0]  # three numbers
    changing, stepping, letters = (max(MIN_RATE, min(0.5, r or 0.0)) for r in rates)

    def gain(count: str, rate: float) -> str:
        share = f"({count} / (n - 1D))"
        return f"(CASE WHEN {share} <= {rate!r}D THEN 0D ELSE (n - 1) * ({share} * ln({share} / {rate!r}D) + CASE WHEN {share} < 1 THEN (1 - {share}) * ln((1 - {share}) / {1 - rate!r}D) ELSE 0D END) END)"

    names = ", ".join(f"'{n}'" for n in ONE_CASE)
    least = f"greatest({gain('changes', changing)}, CASE WHEN encoding IN ({names}) THEN {gain('steps', letters)} ELSE {gain('steps', stepping)} END)"
    step = "CASE " + " ".join(f"WHEN n < {s} THEN {s}" for s in LENGTH_STEPS) + f" ELSE {10 * LENGTH_STEPS[-1]} END"
    out = tested.withColumn("stratum", F.expr(f"concat(encoding, ':', {step})"))
    # twice the lesser of Chernoff's bounds on P(this many changes) and P(this many steps), as whole tenths of a decade, rounded towards 1
    out = out.withColumn("level", F.expr(f"cast(least({MAX_DECADES}, greatest(0, floor(10 * ({least} - ln(2)) / ln(10)))) AS int)"))
    counts = out.groupBy("stratum", "level").count()
    above = Window.partitionBy("stratum").orderBy(F.desc("level"))
    counts = counts.withColumn("found", F.sum("count").over(above)).withColumn("m", F.sum("count").over(Window.partitionBy("stratum")))
    good = counts.where(F.pow(F.lit(10.0), -F.col("level") / 10) * F.col("m") <= fdr * F.col("found"))
    cuts = {r[0]: r[1] for r in good.groupBy("stratum").agg(F.min("level")).collect()}  # one row per encoding and length step
    cut = F.coalesce(*(F.when(F.col("stratum") == s, F.lit(c)) for s, c in sorted(cuts.items())), F.lit(None).cast("int"))
    return out.withColumn("secret", F.coalesce(F.col("level") >= cut, F.lit(False)) & (F.col("p_random") >= random_p))


def find(docs: DataFrame, stage, text: str = "text", keep: tuple[str, ...] = ("doc_id",), body: bool = False, min_token: int = MIN_TOKEN) -> DataFrame:
    """``keep`` columns, ``body`` if asked for, and ``spans``: array of (start, kind, end) in order, kind by its place in KINDS.

    ``stage(df)`` writes and rereads a table: the scan is used for the corpus counts and for the result.
    """
    scanned = scan(docs, text, (*keep,), min_token).withColumn("_row", F.monotonically_increasing_id())
    scanned = stage(scanned if body else scanned.drop("body"))
    tokens = scanned.select("_row", F.explode("token").alias("t")).select("_row", "t.start", "t.end", "t.value")
    found = discoveries(stage(battery(tokens))).where("secret")
    found = found.groupBy("_row").agg(F.collect_list(F.struct("start", F.lit(3).alias("kind"), "end")).alias("random"))  # of one text
    fixed = [f"transform({c}, x -> named_struct('start', x.start, 'kind', {i}, 'end', x.end))" for i, c in enumerate(KINDS[:3])]
    none = "cast(array() AS array<struct<start:int,kind:int,end:int>>)"
    out = scanned.join(found, "_row", "left")
    out = out.withColumn("base", F.expr(f"array_sort(concat({', '.join(fixed)}))"))
    out = out.withColumn("spans", F.expr(f"array_sort(concat(base, coalesce(random, {none})))"))
    return out.select(*keep, *(["body"] if body else []), "assign", "access", "hex", "base", "spans")


def digest(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat(get({names}, x.kind), ':', x.start, ':', x.end)), ',')")


def redacted(mark: str = "[SECRET]") -> Column:
    """``body`` with every span of ``spans`` replaced; overlapping spans become one mark."""
    # the body in pieces of known length, since a place far into a text is found by walking there
    p, q = f"(cast({{at}} AS int) div {PIECE})", f"(cast({{at}} AS int) % {PIECE})"
    bound = f"array(named_struct('c', regexp_extract_all(body, '(?s).{{1,{PIECE}}}', 0), 'r', {_running('size(spans)', 'get(spans, i).end', 'greatest({}, {})'.format)}))"

    def cut(start: str, end: str) -> str:
        first, last, skip, stop = p.format(at=start), p.format(at=end), q.format(at=start), q.format(at=end)
        within = f"substring(get(w.c, {first}), {skip} + 1, {stop} - {skip})"
        across = (
            f"concat(substring(get(w.c, {first}), {skip} + 1), array_join(slice(w.c, cast({first} + 2 AS int), cast({last} - {first} - 1 AS int)), ''),"
            f" coalesce(substring(get(w.c, {last}), 1, {stop}), ''))"
        )
        return f"coalesce(CASE WHEN {first} = {last} THEN {within} ELSE {across} END, '')"

    # what earlier spans reach is cut already; a span that begins inside it adds no mark
    pieces = f"transform(w.r, (r, i) -> CASE WHEN get(spans, i).start >= r THEN concat({cut('r', 'get(spans, i).start')}, '{mark}') ELSE '' END)"
    rest = cut("array_max(transform(spans, x -> x.end))", "length(body)")
    return F.expr(f"CASE WHEN size(spans) = 0 THEN body ELSE get(transform({bound}, w -> concat(array_join({pieces}, ''), {rest})), 0) END")
