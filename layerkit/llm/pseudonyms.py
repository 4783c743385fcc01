"""Format-preserving pseudonyms for personal numbers and dates (native).

Values are found by pattern, validated, and replaced by a keyed permutation
of their own format, a Feistel network whose round function is SHA-256 under
the key. The same value gives the same pseudonym in every document, so
linked records stay linked, and different values stay different.

Kinds, and what a permutation keeps:

* ``email``: the domain, and the place of letters, digits and signs in the
  local part;
* ``date``: layout, a valid date of 1700-2099 (year first or last; days and
  months of one or two digits; between them - or /, and . where the year is
  last). With the year last the day comes first, or the month where only that
  is a date; such a date maps to one that is read the same way;
* ``ip``: a valid IPv4 address;
* ``ssn``: a valid number (area, group and serial in their ranges);
* ``card``: 13-19 digits, unbroken or in groups of 4-4-4-4 or 4-6-5, with the check digit's standing: a
  number that passes the Luhn check maps to one that passes, any other to one
  that does not;
* ``phone``: the layout and the country code (3-3-4 digits, with a country
  code also two to four groups of 2-4 digits).

A candidate that is not valid (an octet over 255, a 30 February) is left
alone.

Defined cases: a NULL text stays NULL and an empty one empty; repeated rows
give equal results; an empty table gives no rows; long texts are one pass of
one pattern; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import col, free_name, let

ROUNDS = 8
KINDS = ("email", "date", "ip", "ssn", "card", "phone")

# pattern -> layouts, the first that gives a date holds
_DATE_LAYOUTS = {
    **{rf"\d{{4}}{c}\d{{2}}{c}\d{{2}}": (f"yyyy{c}MM{c}dd",) for c in "-/"},
    **{rf"\d{{4}}{c}\d{{1,2}}{c}\d{{1,2}}": (f"yyyy{c}M{c}d",) for c in "-/"},
    **{rf"\d{{2}}[{c}]\d{{2}}[{c}]\d{{4}}": (f"dd{c}MM{c}yyyy", f"MM{c}dd{c}yyyy") for c in "/.-"},
    **{rf"\d{{1,2}}[{c}]\d{{1,2}}[{c}]\d{{4}}": (f"d{c}M{c}yyyy", f"M{c}d{c}yyyy") for c in "/.-"},
}
_PATTERNS = {
    # at most 64 characters before the sign, 127 labels of 63 after it, as
    # mail allows: an unbounded group would take a frame per label
    "email": r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){0,125}\.[A-Za-z]{2,}",
    "date": "(?:" + "|".join(_DATE_LAYOUTS) + ")",
    "ip": r"\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "card": r"(?:\d{4}([ -])\d{4}\2\d{4}\2\d{4}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5}|\d{13,19})",
    "phone": r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-](?:\d{2,4}|\(\d{2,4}\))){2,4}|\+\d{8,15}",
}
_START, _END = r"(?<![A-Za-z0-9._%+@-])", r"(?![A-Za-z0-9])"
# one capture for the whole match; group 2 is the card's separator
_NUMBERS = "|".join(_PATTERNS[k] for k in KINDS if k != "email")
CANDIDATE = f"({_START}{_PATTERNS['email']}|(?<![A-Za-z0-9])(?<![0-9][.])(?:{_NUMBERS}){_END})"
# Marks around a candidate: private-use characters; the text's own first mark
# is escaped before, so the pair never occurs in it.
_MARK, _ESCAPED, _ONE = "\ue000\ue001", "\ue000\ue002", "\ue000"


def _digest(key: str, kind: str, r: int, value: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}\x1f{kind}\x1f{r}\x1f"), value), 256)


def _number(hexes: Column) -> Column:
    return F.conv(hexes, 16, 10).cast("long")


def _pair(key: str, kind: str, a: Column, m: int, b: Column, n: int, use: Callable[[Column, Column], Column]) -> Column:
    """A permutation of Z_m x Z_n: alternating modular Feistel rounds."""

    def rounds(r: int, x: Column, y: Column) -> Column:
        if r == ROUNDS:
            return use(x, y)
        z = _number(F.substring(_digest(key, kind, r, y.cast("string")), 1, 15))
        left = r % 2 == 0
        return let((x + z) % F.lit(m if left else n), lambda v: rounds(r + 1, y, v))

    # x is always the half to change next
    return let(a, lambda x: let(b, lambda y: rounds(0, x, y)))


def _shifted(c: Column, by: Column) -> Column:
    """A letter or digit moved within its class; other characters stay."""
    o = F.ascii(c)
    move = lambda first, n: F.char(first + (o - first + by) % n)
    return (
        F.when(o.between(48, 57), move(48, 10)).when(o.between(97, 122), move(97, 26)).when(o.between(65, 90), move(65, 26)).otherwise(c)
    )


def _string(key: str, kind: str, s: Column, use: Callable[[Column], Column]) -> Column:
    """A permutation of all strings of one class pattern: Feistel rounds over
    its two halves, each character moved by a byte of the other's digest."""

    def rounds(r: int, x: Column, y: Column) -> Column:
        # x is the half to change; y the other; after an even number of
        # rounds x is the first half again
        if r == ROUNDS:
            return use(F.concat(x, y))

        def move(d: Column) -> Column:
            at = lambda i: _number(F.substr(d, 1 + 2 * F.pmod(i, F.lit(32)), F.lit(2)))
            moved = F.transform(F.split(x, ""), lambda c, i: _shifted(c, at(i)))
            return F.when(x == "", x).otherwise(F.array_join(moved, ""))

        return let(_digest(key, kind, r, y), lambda d: let(move(d), lambda v: rounds(r + 1, y, v)))

    half = F.floor(F.length(s) / 2).cast("int")
    return let(F.substr(s, F.lit(1), half), lambda a: let(F.substr(s, half + 1), lambda b: rounds(0, a, b)))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refill(layout: Column, digits: Column) -> Column:
    """``digits`` in the digit places of ``layout``."""
    seat = lambda i: F.length(_digits(F.substr(layout, F.lit(1), i))) + 1
    put = lambda c, i: F.when(c.rlike("[0-9]"), F.substr(digits, seat(i), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(layout, ""), put), "")


def _luhn(payload: Column) -> Column:
    """The check digit of a digit string."""
    d = F.transform(F.reverse(F.split(payload, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2).otherwise(c.cast("int")))
    total = F.aggregate(d, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return (10 - total % 10) % 10


def _email(key: str, s: Column) -> Column:
    local, domain = F.substring_index(s, "@", 1), F.substring_index(s, "@", -1)
    return _string(key, "email", local, lambda p: F.concat(p, F.lit("@"), domain))


def _month_first(key: str, n: Column, use: Callable[[Column], Column]) -> Column:
    """A permutation of the dates after the 12th, which alone are read with the
    month first; ``n``: days since 1700."""
    base = F.lit("1700-01-01").cast("date")
    # days of the base's months up to the month, less 12 for each
    upto = lambda m: F.datediff(F.add_months(base, m), base) - 12 * m

    def back(a: Column, b: Column) -> Column:
        def day(k: Column) -> Column:
            near = F.floor(k / 18.436875).cast("int")
            month = F.element_at(F.filter(F.array(*[near + d for d in (-2, -1, 0, 1, 2)]), lambda m: upto(m) <= k), -1)
            return let(month, lambda m: use(F.date_add(F.add_months(base, m), (12 + k - upto(m)).cast("int"))))

        return let(a * 9833 + b, day)

    day = F.date_add(base, n.cast("int"))
    months = (F.year(day) - 1700) * 12 + F.month(day)
    # 88,497 = 9 * 9833 of the 146,097 days of 400 years
    return let((n - 12 * months).cast("long"), lambda k: _pair(key, "month-first", F.floor(k / 9833), 9, k % 9833, 9833, back))


def _date(key: str, s: Column) -> Column:
    base = F.lit("1700-01-01").cast("date")
    parsed = lambda layout: F.datediff(F.try_to_timestamp(s, F.lit(layout)).cast("date"), base).cast("long")

    def read(layout: str, swapped: bool) -> Column:
        # days since 1700, layout and whether the month comes first
        fits = lambda n: F.when(n.isNotNull(), F.struct(n.alias("n"), F.lit(layout).alias("layout"), F.lit(swapped).alias("swapped")))
        return let(parsed(layout), fits)

    found = F.lit(None)
    for pattern, layouts in reversed(_DATE_LAYOUTS.items()):
        first = F.coalesce(*[read(layout, k == 1) for k, layout in enumerate(layouts)])
        found = F.when(s.rlike(f"^{pattern}$"), first).otherwise(found)

    def move(d: Column) -> Column:
        written = lambda day: F.call_function("date_format", day, d["layout"])
        back = lambda a, b: written(F.date_add(base, (a * 773 + b).cast("int")))
        # 146,097 days of 400 years = 189 * 773
        n = d["n"]
        plain = _pair(key, "date", F.floor(n / 773), 189, n % 773, 773, back)
        ok = n.between(0, 146_096)
        return F.when(ok & d["swapped"], _month_first(key, n, written)).when(ok, plain).otherwise(s)

    return let(found, move)


def _ip(key: str, s: Column) -> Column:
    def move(p: Column) -> Column:
        o = [p[k].cast("int") for k in range(4)]
        ok = F.greatest(*o) <= 255
        back = lambda a, b: F.concat_ws(".", *[x.cast("string") for v in (a, b) for x in (F.floor(v / 256), v % 256)])
        pair = _pair(key, "ip", (o[0] * 256 + o[1]).cast("long"), 65536, (o[2] * 256 + o[3]).cast("long"), 65536, back)
        return F.when(ok, pair).otherwise(s)

    return let(F.split(s, r"\."), move)


def _ssn(key: str, s: Column) -> Column:
    def move(p: Column) -> Column:
        area, group, serial = (p[k].cast("long") for k in range(3))
        ok = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        # areas 1-665 and 667-899 as 0-897
        low = F.when(area > 666, area - 2).otherwise(area - 1)

        def back(a: Column, b: Column) -> Column:
            x = F.when(a >= 665, a + 2).otherwise(a + 1)
            pad = lambda v, n: F.lpad(v.cast("string"), n, "0")
            return F.concat_ws("-", pad(x, 3), pad(F.floor(b / 9999) + 1, 2), pad(b % 9999 + 1, 4))

        return F.when(ok, _pair(key, "ssn", low, 898, (group - 1) * 9999 + serial - 1, 99 * 9999, back)).otherwise(s)

    return let(F.split(s, "-"), move)


def _card(key: str, s: Column) -> Column:
    def move(d: Column) -> Column:
        payload, check = F.substr(d, F.lit(1), F.length(d) - 1), F.right(d, F.lit(1)).cast("int")
        off = check - _luhn(payload)
        close = lambda q: F.concat(q, F.pmod(_luhn(q) + off, F.lit(10)).cast("string"))
        return let(_string(key, "card", payload, close), lambda q: _refill(s, q))

    return let(_digits(s), move)


def _phone(key: str, s: Column) -> Column:
    code = F.regexp_extract(s, r"^(\+\d{1,3}(?=[ .(-])|\+\d|)", 1)

    def move(c: Column) -> Column:
        rest = F.substr(s, F.length(c) + 1)
        return F.concat(c, _string(key, "phone", _digits(rest), lambda d: _refill(rest, d)))

    return let(code, move)


_MOVE = {"email": _email, "date": _date, "ip": _ip, "ssn": _ssn, "card": _card, "phone": _phone}


def kind_of(s: Column) -> Column:
    """The kind of a candidate: the first whose pattern it matches whole."""
    out = F.lit(None).cast("string")
    for k in reversed(KINDS):
        pattern = _PATTERNS[k].replace(r"\2", r"\1")
        out = F.when(s.rlike(f"^(?:{pattern})$"), F.lit(k)).otherwise(out)
    return out


def pseudonym(s: Column, kind: Column, key: str) -> Column:
    out = s
    for k in KINDS:
        out = F.when(kind == k, _MOVE[k](key, s)).otherwise(out)
    return out


def replace(text: Column, key: str) -> Column:
    """A struct of the text with pseudonyms (``text``) and how many values of
    each kind were replaced (``found``: a map)."""
    escaped = F.replace(text, F.lit(_ONE), F.lit(_ESCAPED))
    parts = F.split(F.regexp_replace(escaped, CANDIDATE, f"{_MARK}$1{_MARK}"), _MARK)

    def one(s: Column, i: Column) -> Column:
        plain = F.struct(s.alias("s"), F.lit(None).cast("string").alias("kind"))
        moved = let(
            kind_of(s),
            lambda k: let(pseudonym(s, k, key), lambda p: F.struct(p.alias("s"), F.when(p != s, k).alias("kind"))),
        )
        return F.when(i % 2 == 1, moved).otherwise(plain)

    def close(a: Column) -> Column:
        joined = F.array_join(F.transform(a, lambda x: x["s"]), "")
        of_kind = lambda k: F.size(F.filter(a, lambda x: x["kind"] == k)).alias(k)
        counts = [of_kind(k) for k in KINDS]
        return F.struct(F.replace(joined, F.lit(_ESCAPED), F.lit(_ONE)).alias("text"), F.struct(*counts).alias("found"))

    none = F.struct(text.alias("text"), F.struct(*[F.lit(0).alias(k) for k in KINDS]).alias("found"))
    return F.when(text.rlike(CANDIDATE), let(F.transform(parts, one), close)).otherwise(none)


def pseudonymize(docs: DataFrame, key: str, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal values replaced in ``text``; where there is a
    column ``n_chars`` it follows the text of the rows that changed."""
    done, names = free_name(docs.columns, "done"), docs.columns
    out = docs.withColumn(done, replace(col(text), key)).withColumn(text, col(done)["text"])
    if n_chars in names:
        changed = sum((col(done)["found"][k] for k in KINDS), F.lit(0)) > 0
        n = F.length(col(text)).cast(docs.schema[n_chars].dataType)
        out = out.withColumn(n_chars, F.when(changed, n).otherwise(col(n_chars)))
    return out.select([col(c) for c in names])
