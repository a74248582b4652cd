"""Format-preserving pseudonyms for personal data in texts.

Validated values are permuted within their format by a keyed Feistel network: an address
stays an address, a card number keeps a valid check digit, a date stays a date. The
permutation depends on the key and the kind of value alone, so equal values get equal
pseudonyms in all documents, and different values different ones. All expressions are
built in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

_SECRET = r"(?i:password|passwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._+-])[A-Za-z0-9._+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": rf"\b{_SECRET}[A-Za-z0-9+/_-]{{8,}}",
    "phone": r"\+\d{1,3}[ -]?\(?\d{2,4}\)?(?:[ -]?\d{2,4}){2,3}\b|\(\d{3}\) ?\d{3}-\d{4}\b|\b\d{3}-\d{3}-\d{4}\b",
    "ip": r"\b\d{1,3}(?:\.\d{1,3}){3}\b",
    "date": r"\b\d{4}-\d{2}-\d{2}\b|\b\d{1,2}\.\d{1,2}\.\d{4}\b|\b\d{1,2}/\d{1,2}/\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "card": r"\b\d{4}(?:[ -]\d{4}){3}\b|\b\d{13,19}\b",
}
KINDS = list(PATTERNS)
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Every value has one of these, so other texts are passed on as they are.
_HINT = "[0-9@=:]"

# A cycle of the calendar: 400 years have this many days, the product of the two factors.
_DAYS, _DAY_A, _DAY_B = 146_097, 189, 773
_FIRST_YEAR, _LAST_YEAR = 1600, 2399


def _number(key: str, kind: str, step: Column, half: Column, modulus: int) -> Column:
    """The round function for numbers: a keyed hash modulo a domain."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long") % modulus


def _permuted_number(x: Column, key: str, kind: str, a: int, b: int) -> Column:
    """Permute 0 .. a * b - 1 by alternating additions to its two digits."""

    def turn(acc: Column, step: Column) -> Column:
        left = (acc["l"] + _number(key, kind, step, acc["r"], a)) % a
        right = (acc["r"] + _number(key, kind, step, acc["l"], b)) % b
        even = step % 2 == 0
        return F.struct(
            F.when(even, left).otherwise(acc["l"]).alias("l"),
            F.when(even, acc["r"]).otherwise(right).alias("r"),
        )

    start = F.struct(F.floor(x / b).cast("long").alias("l"), (x % b).cast("long").alias("r"))
    steps = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(steps, start, turn, lambda acc: acc["l"] * b + acc["r"])


def _shifted(chars: Column, stream: Column) -> Column:
    """Shift digits among digits and letters among letters of their case.

    The stream is bound by way of a one-element array, so that it is made once, and the
    characters are an array, so that the cost is in proportion to their number.
    """

    def one(char: Column, i: Column, by: Column) -> Column:
        code = F.ascii(char)
        # 64 bytes of stream; longer halves use them again
        step = F.conv(F.substring(by, F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        first = F.when(code < 58, 48).when(code < 91, 65).otherwise(97)
        size = F.when(code < 58, 10).otherwise(26)
        return F.char((first + (code - first + step) % size).cast("long"))

    each = lambda by: F.array_join(F.transform(F.split(chars, ""), lambda c, i: one(c, i, by)), "")
    made = F.element_at(F.transform(F.array(stream), each), 1)
    return F.when(F.length(chars) > 0, made).otherwise("")


def _permuted_chars(core: Column, key: str, kind: str) -> Column:
    """Permute a string of ASCII letters and digits; each place keeps its class."""
    cut = F.greatest(F.lit(1), F.floor(F.length(core) / 2).cast("int"))

    def turn(acc: Column, step: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), acc["r"])
        return F.struct(
            acc["r"].alias("l"), _shifted(acc["l"], F.sha2(text, 512)).alias("r")
        )

    start = F.struct(
        F.substring(core, F.lit(1), cut).alias("l"),
        F.substring(core, cut + 1, F.length(core)).alias("r"),
    )
    steps = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(steps, start, turn, lambda acc: F.concat(acc["l"], acc["r"]))


def _core(value: Column) -> Column:
    return F.regexp_replace(value, "[^A-Za-z0-9]", "")


def _refilled(value: Column, core: Column) -> Column:
    """The value with its letters and digits replaced, in order, by those of ``core``."""
    between = F.split(value, "[A-Za-z0-9]", -1)
    return F.array_join(
        F.zip_with(
            between,
            F.split(core, ""),
            lambda b, c: F.concat(F.coalesce(b, F.lit("")), F.coalesce(c, F.lit(""))),
        ),
        "",
    )


def _luhn(digits: Column, odd: int) -> Column:
    """Luhn sum; from the right, digits at places of parity ``odd`` are doubled."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == odd, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(value: Column, key: str) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    body = _permuted_chars(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    # the check digit of a permuted body, by way of a one-element array, so it is made once
    full = F.element_at(
        F.transform(
            F.array(body),
            lambda b: F.concat(b, F.pmod(10 - _luhn(b, 0) % 10, F.lit(10)).cast("string")),
        ),
        1,
    )
    return F.when(_luhn(digits, 1) % 10 == 0, _refilled(value, full)).otherwise(value)


def _ip(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc * 256 + p)
    made = F.element_at(
        F.transform(
            F.array(_permuted_number(number, key, "ip", 1 << 16, 1 << 16)),
            lambda x: F.concat_ws(
                ".", *[(F.shiftright(x, s).bitwiseAND(F.lit(255))).cast("string") for s in (24, 16, 8, 0)]
            ),
        ),
        1,
    )
    return F.when(F.forall(parts, lambda p: p < 256), made).otherwise(value)


def _date(value: Column, key: str) -> Column:
    """Years 1600 to 2399, in cycles of 400; days come first if that is a valid date."""
    iso = value.rlike("^[0-9]{4}-")
    numbers = F.transform(F.split(value, "[-./]"), lambda p: p.cast("int"))

    def valid(y: Column, m: Column, d: Column) -> Column:
        last = F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
        return F.when(
            y.between(_FIRST_YEAR, _LAST_YEAR) & m.between(1, 12) & (d >= 1), d <= last
        ).otherwise(F.lit(False))

    a, b, c = (F.element_at(numbers, i) for i in (1, 2, 3))
    mark = F.when(value.contains("/"), "/").otherwise(".")
    wide = F.when(value.rlike("^0|[./]0"), 2).otherwise(1)

    def made(y: Column, m: Column, d: Column, show) -> Column:
        first = F.make_date((F.floor(y / 400) * 400).cast("int"), F.lit(1), F.lit(1))
        day = F.datediff(F.make_date(y, m, d), first).cast("long")
        moved = _permuted_number(day, key, "date", _DAY_A, _DAY_B)
        dates = F.array(F.date_add(first, moved.cast("int")))
        return F.element_at(F.transform(dates, show), 1)

    def padded(part: Column) -> Column:
        text = part.cast("string")
        return F.when(F.length(text) < wide, F.concat(F.lit("0"), text)).otherwise(text)

    year = lambda x: F.lpad(F.year(x).cast("string"), 4, "0")
    day_first = lambda x: F.concat(padded(F.dayofmonth(x)), mark, padded(F.month(x)), mark, year(x))
    month_first = lambda x: F.concat(padded(F.month(x)), mark, padded(F.dayofmonth(x)), mark, year(x))
    return (
        F.when(iso & valid(a, b, c), made(a, b, c, lambda x: F.date_format(x, "yyyy-MM-dd")))
        .when(~iso & valid(c, b, a), made(c, b, a, day_first))
        .when(~iso & valid(c, a, b), made(c, a, b, month_first))
        .otherwise(value)
    )


def _chars_after(value: Column, kept: str, key: str, kind: str) -> Column:
    """Permute what follows the part that matches ``kept``."""
    head = F.regexp_extract(value, f"^(?:{kept})", 0)
    rest = F.substring(value, F.length(head) + 1, F.length(value))
    return F.concat(head, _refilled(rest, _permuted_chars(_core(rest), key, kind)))


def _email(value: Column, key: str) -> Column:
    local = F.substring_index(value, "@", 1)
    made = _refilled(local, _permuted_chars(_core(local), key, "email"))
    return F.when(
        F.length(_core(local)) > 0, F.concat(made, F.lit("@"), F.substring_index(value, "@", -1))
    ).otherwise(value)


def kind_of(value: Column) -> Column:
    found = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        found = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(found)
    return found


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one matched value; values that are not valid stay as they are."""
    makers = {
        "email": lambda v: _email(v, key),
        "secret": lambda v: _chars_after(v, _SECRET, key, "secret"),
        "phone": lambda v: _chars_after(v, r"\+\d{1,3}(?=[ (-])|", key, "phone"),
        "ip": lambda v: _ip(v, key),
        "date": lambda v: _date(v, key),
        "ssn": lambda v: _chars_after(v, "", key, "ssn"),
        "card": lambda v: _card(v, key),
    }
    made = value
    for kind, pattern in reversed(PATTERNS.items()):
        made = F.when(value.rlike(f"^(?:{pattern})$"), makers[kind](value)).otherwise(made)
    return made


def _rebuilt(text: Column, key: str) -> tuple[Column, Column]:
    values = F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))
    return F.split(text, _ANY), values


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text", prefix: str = "_p_") -> DataFrame:
    """Replace personal data in the text column; other columns stay.

    Adds ``{prefix}found``, the kinds of the replaced values (an empty array if there are
    none). Null stays null and empty stays empty. One pass, without a shuffle.
    """
    parts, values, made = f"{prefix}parts", f"{prefix}values", f"{prefix}made"
    have = list(docs.columns)
    marked = F.coalesce(F.col(text_col).rlike(_HINT), F.lit(False))
    between, found = _rebuilt(F.col(text_col), key)
    rows = docs.withColumn(values, F.when(marked, found)).withColumn(
        parts, F.when(F.size(values) > 0, between)
    )
    rows = rows.withColumn(
        made, F.when(F.size(values) > 0, F.transform(values, lambda v: pseudonym(v, key)))
    )
    text = F.array_join(
        F.zip_with(parts, made, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), ""
    )
    changed = F.filter(
        F.zip_with(values, made, lambda v, m: F.when(v != m, kind_of(v))), lambda k: k.isNotNull()
    )
    return rows.select(
        *[F.coalesce(text, F.col(c)).alias(c) if c == text_col else F.col(c) for c in have],
        F.coalesce(changed, F.array().cast("array<string>")).alias(f"{prefix}found"),
    )


def replace(docs: DataFrame, key: str, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns, with pseudonyms in the text; a length column follows the text."""
    columns = list(docs.columns)
    rows = pseudonymised(docs, key, text_col).select(*columns)
    if length_col not in columns:
        return rows
    length = F.length(text_col).cast(docs.schema[length_col].dataType)
    return rows.withColumn(
        length_col, F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(length)
    )


def report(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` with pseudonyms, and ``n_<kind>``: values replaced, by kind."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = pseudonymised(rows, key)

    def count(kind: str) -> Column:
        return F.size(F.filter("_p_found", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", "text", *map(count, KINDS))
