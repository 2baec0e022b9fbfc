"""Format-preserving pseudonyms for personal numbers and dates, in DataFrame expressions only.

Values found in a text are validated, then permuted within their format by a keyed
Feistel network, so a value has the same pseudonym in every document and different
values of a format have different ones:

* card numbers (13 to 19 digits, Luhn): all digits but the check digit, which is set anew
* US social security numbers and international phone numbers: their digits; the phone's
  country code stays
* IPv4 addresses: the 32 bits
* dates (yyyy-mm-dd, dd.mm.yyyy, dd/mm/yyyy) from 1900 to 2100: the day number
* e-mail addresses: letters and digits of the local part, each within its kind

Separators stay in place, so formats of one number share the pseudonym's digits.
The key is a parameter. Everything is per row: no shuffle, no state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# Dates are permuted among 365 x 201 days from here on.
FIRST_DAY = "1900-01-01"
_DAYS = (365, 201)

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]*+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}"
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
PHONE = r"\+[0-9]{1,3}[ .\-]?\(?[0-9]{3}\)?[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])"
SSN = r"(?<![0-9\-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9\-])"
DATE = r"(?<![0-9.\-/])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})(?![0-9])"
CARD = (
    r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})"
    r"(?![0-9])"
)
PATTERN = "|".join((EMAIL, IPV4, PHONE, SSN, DATE, CARD))


def _prf(key: str, tag: Column | str, turn: Column, value: Column) -> Column:
    """A 60-bit number from the key, the format, the round and one half."""
    tag = F.lit(tag) if isinstance(tag, str) else tag
    digest = F.sha2(F.concat_ws("|", F.lit(key), tag, turn.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(key: str, tag: Column | str, a: Column, b: Column, m: Column, k: Column) -> Column:
    """Permute pairs (a, b) of Z_m x Z_k; a struct of the two halves."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def turn(s: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, F.pmod(s["a"] + F.pmod(_prf(key, tag, i, s["b"]), m), m))
        right = F.when(i % 2 == 1, F.pmod(s["b"] + F.pmod(_prf(key, tag, i, s["a"]), k), k))
        return F.struct(
            F.coalesce(left, s["a"]).cast("long").alias("a"),
            F.coalesce(right, s["b"]).cast("long").alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def permute_digits(key: str, tag: str, digits: Column) -> Column:
    """A string of up to 18 digits permuted among those of its length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    power = lambda e: F.pow(F.lit(10.0), e).cast("long")
    part = lambda s: F.when(s == "", 0).otherwise(s.try_cast("long"))
    left, right = F.substring(digits, F.lit(1), u), F.substring(digits, u + 1, v)
    both = feistel(key, F.concat(F.lit(tag), n.cast("string")), part(left), part(right),
                   power(u), power(v))
    pad = lambda x, width: F.lpad(x.cast("string"), width, F.lit("0"))
    joined = F.transform(F.array(both), lambda s: F.concat(
        F.when(u > 0, pad(s["a"], u)).otherwise(""), pad(s["b"], v)))
    return F.element_at(joined, 1)


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    def put(c: Column, i: Column) -> Column:
        before = F.length(_digits(F.substring(shape, F.lit(1), i)))
        return F.when(c.rlike("[0-9]"), F.substring(digits, before + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(shape, ""), put), "")


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum of digits; from the right, those at even (0) or odd (1) places are doubled."""
    def add(total: Column, c: Column) -> Column:
        value = c["d"] * F.when(c["i"] % 2 == doubled, 2).otherwise(1)
        return total + F.when(value > 9, value - 9).otherwise(value)

    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")),
    )
    return F.aggregate(places, F.lit(0), add)


def _card(key: str, value: Column) -> Column:
    """A valid card number's pseudonym, valid again; null for other numbers."""
    digits = _digits(value)
    body = permute_digits(key, "card", F.substring(digits, F.lit(1), F.length(digits) - 1))
    whole = F.transform(F.array(body), lambda b: F.concat(
        b, F.pmod(-luhn_sum(b, 0), F.lit(10)).cast("string")))
    return F.when(luhn_sum(digits, 1) % 10 == 0, _refill(value, F.element_at(whole, 1)))


def _phone(key: str, value: Column) -> Column:
    """The country code stays; the ten digits after it are permuted."""
    digits = _digits(value)
    code = F.length(digits) - 10
    ten = permute_digits(key, "phone", F.substring(digits, code + 1, F.lit(10)))
    return _refill(value, F.concat(F.substring(digits, F.lit(1), code), ten))


def _ipv4(key: str, value: Column) -> Column:
    octet = lambda i: F.split(value, r"\.")[i].cast("long")
    size = F.lit(65536)
    both = feistel(key, "ipv4", octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), size, size)
    quad = lambda s: F.concat_ws(".", *[
        x.cast("string") for h in ("a", "b") for x in (F.shiftright(s[h], 8), s[h] % 256)])
    return F.element_at(F.transform(F.array(both), quad), 1)


def _date(key: str, value: Column) -> Column:
    """A real date's pseudonym in the same notation; null for dates outside the range."""
    formats = {"-": "yyyy-MM-dd", ".": "dd.MM.yyyy", "/": "dd/MM/yyyy"}
    mark = F.when(value.contains("-"), "-").when(value.contains("."), ".").otherwise("/")
    parsed = F.coalesce(*[
        F.when(mark == m, F.try_to_timestamp(value, F.lit(f)).cast("date")) for m, f in formats.items()
    ])
    day = F.datediff(parsed, F.lit(FIRST_DAY).cast("date"))
    m, k = _DAYS
    both = feistel(key, "date", F.floor(day / k), day % k, F.lit(m), F.lit(k))
    shown = lambda s: F.date_add(
        F.lit(FIRST_DAY).cast("date"), (s["a"] * k + s["b"]).cast("int"))
    text = lambda s: F.coalesce(*[
        F.when(mark == mk, F.date_format(shown(s), f)) for mk, f in formats.items()])
    return F.when((day >= 0) & (day < m * k), F.element_at(F.transform(F.array(both), text), 1))


def _shift(text: Column, digest: Column) -> Column:
    """Every letter and digit of ``text`` moved on within its kind by a byte of ``digest``."""
    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(digest, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for first, size in (("a", 26), ("A", 26), ("0", 10)):
            code = ord(first)
            kind = (F.ascii(c) >= code) & (F.ascii(c) < code + size)
            out = F.when(kind, F.char(F.pmod(F.ascii(c) - code + by, F.lit(size)) + code)).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), move), "")


def _email(key: str, value: Column) -> Column:
    """Feistel over the two halves of the local part; blind to case, which stays."""
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    u = F.floor(F.length(local) / 2).cast("int")
    start = F.struct(
        F.substring(local, F.lit(1), u).alias("a"),
        F.substring(local, u + 1, F.length(local)).alias("b"),
    )

    def turn(s: Column, i: Column) -> Column:
        digest = lambda half: F.sha2(
            F.concat_ws("|", F.lit(key), F.lit("email"), i.cast("string"), F.lower(half)), 256)
        return F.struct(
            F.when(i % 2 == 0, _shift(s["a"], digest(s["b"]))).otherwise(s["a"]).alias("a"),
            F.when(i % 2 == 1, _shift(s["b"], digest(s["a"]))).otherwise(s["b"]).alias("b"),
        )

    both = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)
    return F.element_at(
        F.transform(F.array(both), lambda s: F.concat(s["a"], s["b"], F.lit("@"), domain)), 1)


def pseudonym(key: str, value: Column) -> Column:
    """The pseudonym of one match of ``PATTERN``; null where validation fails."""
    return (
        F.when(value.contains("@"), _email(key, value))
        .when(value.startswith("+"), _phone(key, value))
        .when(value.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), _ipv4(key, value))
        .when(value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
              _refill(value, permute_digits(key, "ssn", _digits(value))))
        .when(value.rlike("^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})$"),
              _date(key, value))
        .otherwise(_card(key, value))
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str = "n_pii") -> DataFrame:
    """``docs`` with personal values in ``text_col`` replaced, and their number in ``count_col``.

    Null and empty texts stay as they are with count 0; text outside validated values
    is untouched. Rows without a candidate do no more than one search. Other columns
    pass as they are, whatever they are called; one already called ``count_col`` is
    replaced.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.col("row").getField(text_col)
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    changed = F.transform(found, lambda m: F.struct(
        m.alias("old"), pseudonym(key, m).alias("new")))
    some = F.coalesce(text.rlike(PATTERN), F.lit(False))
    staged = docs.select(row).withColumn("pii", F.when(some, changed))
    gaps = F.split(text, PATTERN, -1)
    put = F.array_join(F.zip_with(gaps, F.col("pii"), lambda gap, m: F.concat(
        gap, F.coalesce(m["new"], m["old"], F.lit("")))), "")
    count = F.size(F.filter("pii", lambda m: m["new"].isNotNull()))
    hit = F.col("pii").isNotNull()
    made = {
        text_col: F.when(hit, put).otherwise(text),
        count_col: F.when(hit, count).otherwise(0),
    }
    names = [*docs.columns, *([] if count_col in docs.columns else [count_col])]
    return staged.select(*[
        made.get(c, F.col("row").getField(c)).alias(c) for c in names
    ])
