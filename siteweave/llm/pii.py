"""Format-preserving pseudonyms for personal data, with built-in functions only.

One pattern finds candidates in one pass that puts marks around them; the text is cut at the marks
and put together again with each match replaced, so a text is one expression and no user function
runs. Numbers (card numbers that pass the Luhn check, IBANs that pass theirs, phone numbers, IP
addresses) and real calendar dates are permuted by a keyed Feistel network inside their own format;
the halves are added modulo their sizes, so the network is a permutation of exactly that domain.
Numbers are permuted without their separators, so equal values get equal pseudonyms in every document
and every spelling, each in the spelling it had. Mail names and long hexadecimal secrets become keyed
digests of the same kind. The permutation is as secret as its key, so the key has no default.

Not found: phone numbers without "+", national numbers of persons, IPv6 addresses, names.

Defined edge cases: a null text stays null (n_private 0), an empty one empty; numbers that
fail their check and dates that don't exist or lie outside 1800-2199 stay as they are; the
other columns pass through unread; repeated rows and empty tables need nothing special.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
MAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}_%+\-][\p{L}\p{N}._%+\-]*+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}"
PHONE = r"(?<![\w+])\+\d{1,3}[ .\-]?\(?\d{2,4}\)?[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)"
ADDRESS = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"
DAY = r"(?<![\d\-./])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![\d\-/])"
SECRET = r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,64}(?![0-9A-Za-z])"
CARD = r"(?<![\d\w.\-])(?:\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|\d{13,19})(?![\d\w])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
PATTERN = "|".join((MAIL, PHONE, ADDRESS, DAY, SECRET, IBAN, CARD))
#: Marks before and after a match; a text that holds one is cut in another way, with the same result.
BEFORE, AFTER = "\ue000", "\ue001"

#: 400 years have 146097 = 189 * 773 days.
DAY_SIZES, FIRST_DAY = (189, 773), "1800-01-01"


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _digest(key: str, kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts]), 256)


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """struct(x, y): the pair permuted within [0, a) x [0, b)."""
    start = F.struct(left.cast("long").alias("x"), right.cast("long").alias("y"))

    def rounds(sizes):
        def step(s, i):
            mixed = F.conv(F.substring(_digest(key, kind, i, s["y"]), 1, 12), 16, 10).cast("long")
            return F.struct(s["y"].alias("x"), F.pmod(s["x"] + mixed, F.get(sizes, i % 2)).alias("y"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)

    return _let(F.array(a.cast("long"), b.cast("long")), rounds)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """As many digits (2 to 36) again."""

    def halves(d):
        n, half = F.length(d), F.floor(F.length(d) / 2).cast("int")
        pair = feistel(F.substring(d, F.lit(1), half), F.substring(d, half + 1, n), _power(half), _power(n - half), key, kind)
        return _let(pair, lambda p: F.concat(F.lpad(p["x"].cast("string"), half, "0"), F.lpad(p["y"].cast("string"), n - half, "0")))

    return _let(digits, halves)


def _chars(x: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.substring(x, i, F.lit(1)))


def _is_digit(c: Column) -> Column:
    return c.between("0", "9")


def _luhn_sum(digits: Column, shift: int) -> Column:
    """Sum with every second digit doubled, counted from the right; shift 1 doubles the last."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n + 1 - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((i + shift) % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def luhn_valid(digits: Column) -> Column:
    return _luhn_sum(digits, 0) % 10 == 0


def _refilled(shape: Column, digits: Column) -> Column:
    """The shape with its digits replaced one by one."""

    def filled(d):
        def add(s, c):
            new = F.when(_is_digit(c), F.substring(d, s["k"], F.lit(1))).otherwise(c)
            return F.struct(F.concat(s["out"], new).alias("out"), F.when(_is_digit(c), s["k"] + 1).otherwise(s["k"]).alias("k"))

        return F.aggregate(_chars(shape), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), add, lambda s: s["out"])

    return _let(digits, filled)


def _card(m: Column, key: str) -> Column:
    def replaced(digits):
        body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
        whole = _let(body, lambda x: F.concat(x, F.pmod(F.lit(10) - _luhn_sum(x, 1) % 10, F.lit(10)).cast("string")))
        return F.when((F.length(digits) > 2) & luhn_valid(digits), _refilled(m, whole)).otherwise(m)

    return _let(F.regexp_replace(m, r"\D", ""), replaced)


def _phone(m: Column, key: str) -> Column:
    """All digits are permuted together; the first one stays another digit than 0."""

    def replaced(digits):
        n, half = F.length(digits), F.floor(F.length(digits) / 2).cast("int")
        least = _power(half - 1)
        pair = feistel(F.substring(digits, F.lit(1), half).cast("long") - least, F.substring(digits, half + 1, n), 9 * least, _power(n - half), key, "phone")
        new = _let(pair, lambda p: F.concat((p["x"] + least).cast("string"), F.lpad(p["y"].cast("string"), n - half, "0")))
        return F.when(digits.startswith("0"), m).otherwise(_refilled(m, new))

    return _let(F.regexp_replace(m, r"\D", ""), replaced)


def _mod97(x: Column) -> Column:
    """Of a text of digits and letters, letters counted as 10 to 35."""
    value = lambda c: F.when(_is_digit(c), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.transform(_chars(x), value), F.lit(0), lambda r, v: (r * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _iban(m: Column, key: str) -> Column:
    """The country and the letters stay, the other digits are permuted, the check digits are made new."""

    def replaced(plain):
        body, country = F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(2))
        digits = F.regexp_replace(body, r"\D", "")

        def whole(new):
            check = F.lpad((98 - _mod97(F.concat(_refilled(body, new), country, F.lit("00")))).cast("string"), 2, "0")
            return _refilled(m, F.concat(check, new))

        valid = (_mod97(F.concat(body, F.substring(plain, F.lit(1), F.lit(4)))) == 1) & F.length(digits).between(2, 36)
        return F.when(valid, _let(permuted_digits(digits, key, "iban"), whole)).otherwise(m)

    return _let(F.replace(m, F.lit(" "), F.lit("")), replaced)


def _address(m: Column, key: str) -> Column:
    part = lambda i: F.split_part(m, F.lit("."), F.lit(i)).cast("long")
    pair = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), F.lit(65536), F.lit(65536), key, "address")
    return _let(pair, lambda p: F.concat_ws(".", *[x.cast("string") for h in "xy" for x in (F.floor(p[h] / 256), p[h] % 256)]))


def _day(m: Column, key: str) -> Column:
    for_format = {"yyyy-MM-dd": r"^\d{4}-", "dd.MM.yyyy": r"^\d{2}\.\d{2}\.", "dd/MM/yyyy": r"^\d{2}/\d{2}/"}
    out, (a, b) = m, DAY_SIZES

    def moved(fmt):
        new = lambda p: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (p["x"] * b + p["y"]).cast("int")), fmt)
        return lambda n: F.when((n >= 0) & (n < a * b), _let(feistel(F.floor(n / b), n % b, F.lit(a), F.lit(b), key, "day"), new)).otherwise(m)

    for fmt, shape in for_format.items():
        n = F.datediff(F.try_to_timestamp(m, F.lit(fmt)).cast("date"), F.lit(FIRST_DAY).cast("date"))
        out = F.when(m.rlike(shape), _let(n, moved(fmt))).otherwise(out)
    return out


def pseudonym(m: Column, key: str) -> Column:
    """What a match of PATTERN is replaced by; itself if it fails its check."""
    return (
        F.when(F.contains(m, F.lit("@")), F.concat(F.lit("u"), F.substring(_digest(key, "mail", F.lower(m)), 1, 12), F.lit("@pseudonym.invalid")))
        .when(m.startswith("+"), _phone(m, key))
        .when(m.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), _address(m, key))
        .when(m.rlike(r"^(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})$"), _day(m, key))
        .when(m.rlike(r"^[0-9a-fA-F]{32,64}$"), F.substring(_digest(key, "secret", m), F.lit(1), F.length(m)))
        .when(m.rlike("^[A-Z]"), _iban(m, key))
        .otherwise(_card(m, key))
    )


def _cut(t: Column) -> Column:
    """The text between matches, a match, the text between, ... in turn."""
    marked = F.split(F.regexp_replace(t, f"({PATTERN})", f"{BEFORE}$1{AFTER}"), f"[{BEFORE}{AFTER}]")
    searched_twice = F.flatten(F.zip_with(F.split(t, PATTERN), F.concat(F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0)), F.array(F.lit(""))), lambda a, b: F.array(a, b)))
    return F.when(t.rlike(f"[{BEFORE}{AFTER}]"), searched_twice).otherwise(marked)


def pseudonymised(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """The documents with private values replaced in the text; ``count`` names a column for how many. Map only."""
    t = F.col(f"`{text}`")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    # A text without any digit or @ holds nothing to replace and skips the search.
    parts = docs.select(row, F.when(t.rlike("[0-9@]"), _cut(t)).alias("__parts"))
    # a part with an odd place is a match; cut and searched once, each is replaced once
    named = parts.select("__row", "__parts", F.transform("__parts", lambda p, i: F.when((i % 2 == 1) & (p != ""), pseudonym(p, key)).otherwise(p)).alias("__new"))
    old = F.col("__row")[text]
    text_now = F.when(F.size("__parts") > 1, F.array_join("__new", "")).otherwise(old)
    changed = F.coalesce(F.size(F.filter(F.zip_with("__parts", "__new", lambda a, b: a != b), lambda x: x)), F.lit(0)).cast("long")
    changed = F.greatest(changed, F.lit(0).cast("long"))
    extra = [] if count is None else [changed.alias(count)]
    return named.select(*[text_now.alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns], *extra)
