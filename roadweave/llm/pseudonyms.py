"""Format-preserving pseudonyms of personal numbers and dates, by built-in functions alone.

Candidates are found by pattern and validated. A valid value is a point of a product of two ranges, such as the halves of
a card's digits; a Feistel network over the pair, whose rounds add a keyed digest of one half to the other, permutes the
points. So the pseudonym has the same format and is valid, equal values get equal pseudonyms in every document, and
who has the key can go back. E-mail addresses and account numbers are permuted likewise, sign by sign within lower
case, upper case and digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadweave.llm.common import text_of

KEY_SETTING = "spark.roadweave.pseudonym.key"
LEAST_KEY = 16
ROUNDS = 10

# Word signs in any script, and the patterns of candidates, tried in this order.
W = r"\p{L}\p{M}\p{N}_"
EMAIL = (
    rf"(?<![{W}.+%-])[\p{{L}}0-9][\p{{L}}\p{{M}}0-9._%+-]{{0,63}}@[\p{{L}}\p{{M}}0-9-]{{1,63}}(?:\.[\p{{L}}\p{{M}}0-9-]{{1,63}})*"
    rf"\.[A-Za-z]{{2,24}}(?![{W}-])"
)
IPV4 = rf"(?<![{W}.])(?:\d{{1,3}}\.){{3}}\d{{1,3}}(?![{W}]|\.\d)"
IBAN = rf"(?<![{W}])[A-Z]{{2}}\d{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?)(?![{W}])"
DATE = (
    rf"(?<![{W}/.-])(?:\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}}/\d{{1,2}}/\d{{4}}|\d{{1,2}}\.\d{{1,2}}\.\d{{4}})"
    rf"(?:(?=T\d{{2}}:?\d{{2}})|(?![{W}/-]|\.\d))"
)
SSN = rf"(?<![{W}-])\d{{3}}-\d{{2}}-\d{{4}}(?![{W}-])"
CARD = (
    rf"(?<![{W}-])(?:\d{{13,19}}|\d{{4}}(?:-\d{{4}}){{3}}(?:-\d{{1,3}})?|\d{{4}}(?: \d{{4}}){{3}}(?: \d{{1,3}})?"
    rf"|\d{{4}}-\d{{6}}-\d{{5}}|\d{{4}} \d{{6}} \d{{5}})(?![{W}-])"
)
# Numbers in pairs: after a country code, a trunk 0, or as in Spain.
PAIRS = (
    rf"(?<![{W}.+-])(?:\+\d{{1,3}}[ .-]?(?:\(0\)[ .-]?)?(?:\d(?:[ .-]\d{{2}}){{4}}|\d{{2}}(?:[ .-]\d{{2}}){{3,4}}|\d{{2}}[ .-]\d{{3}}(?:[ .-]\d{{2}}){{2}}|\d{{3,4}}(?:[ .-]\d{{2}}){{3}})"
    rf"|0\d(?:[ .-]\d{{2}}){{4}}|0\d{{2,4}}(?:[ .-]\d{{2}}){{3,4}}|[6-9]\d{{2}}(?:[ .-]\d{{2}}){{3}}|[89]\d[ .-]\d{{3}}(?:[ .-]\d{{2}}){{2}})(?![{W}-])"
)
# An area code, its trunk 0 after the country code or before a slash, then the number in one piece.
TRUNK = rf"(?<![{W}/.+-])(?:\+\d{{1,3}}[ .-]?\(0\)[ .-]?\d{{2,5}}[ ./-]?\d{{4,8}}|0\d{{1,4}} ?/ ?\d{{4,9}})(?![{W}/-])"
PHONE = (
    rf"(?<![{W}.-])(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)[ .-]?|\d{{2,4}}[ .-])\d{{3,4}}[ .-]?\d{{3,4}}(?![{W}-])|(?<![{W}])\+\d{{9,15}}(?![{W}])"
    rf"|{PAIRS}|{TRUNK}"
)
ANY = "|".join(f"(?:{p})" for p in (EMAIL, IPV4, IBAN, DATE, SSN, CARD, PHONE))
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
# Factors of the number of days from the first to the last.
DAYS = (17, 4297)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digest(key: str, kind: str, i: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), half.cast("string")), 256)


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """Struct (l, r): a keyed permutation of the pairs (left, right) with left below a and right below b."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(acc: Column, i: Column) -> Column:
        other = F.when(i % 2 == 1, acc["r"]).otherwise(acc["l"])
        add = _number(F.substring(_digest(key, kind, i, other), 1, 15))
        return F.struct(
            F.when(i % 2 == 1, (acc["l"] + add % a) % a).otherwise(acc["l"]).alias("l"),
            F.when(i % 2 == 1, acc["r"]).otherwise((acc["r"] + add % b) % b).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _shifted(sign: Column, add: Column) -> Column:
    """A sign moved within its class; others stay."""
    out = sign
    for first, size in (("0", 10), ("A", 26), ("a", 26), ("à", 23), ("ø", 8)):
        code = F.ascii(sign) - F.lit(ord(first))
        moved = F.char(F.lit(ord(first)) + (code + add % size) % size)
        out = F.when(sign.between(first, chr(ord(first) + size - 1)), moved).otherwise(out)
    return out


def feistel_text(text: Column, key: str, kind: str) -> Column:
    """A keyed permutation of strings with the same classes of signs in the same places, in two halves."""
    middle = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), middle).alias("l"), F.substring(text, middle + 1, F.length(text)).alias("r"))

    def moved(half: Column, other: Column, i: Column) -> Column:
        def signs(stream: Column) -> Column:
            return F.array_join(
                F.transform(
                    F.filter(F.split(half, ""), lambda c: c != ""),
                    # two hex digits of key stream a sign; it repeats after 60 signs, another part of it each time
                    lambda c, k: _shifted(c, _number(F.substring(stream, (k * 2) % 61 + 1, F.lit(4))) + k),
                ),
                "",
            )

        return _let(_digest(key, kind, i, other), signs)

    def turn(acc: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, moved(acc["l"], acc["r"], i)).otherwise(acc["l"]).alias("l"),
            F.when(odd, acc["r"]).otherwise(moved(acc["r"], acc["l"], i)).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: F.concat(acc["l"], acc["r"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order, separators kept."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def put(acc: Column, sign: Column) -> Column:
        is_digit = sign.rlike("^[0-9]$")
        return F.struct(
            F.concat(acc["out"], F.when(is_digit, F.substring(digits, acc["n"] + 1, F.lit(1))).otherwise(sign)).alias("out"),
            (acc["n"] + is_digit.cast("int")).alias("n"),
        )

    return F.aggregate(F.filter(F.split(value, ""), lambda c: c != ""), start, put, lambda acc: acc["out"])


def _padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width if isinstance(width, Column) else F.lit(width), F.lit("0"))


def luhn_digit(digits: Column) -> Column:
    """The check digit to append."""
    start = F.lit(0)

    def add(acc: Column, x: Column) -> Column:
        doubled = x["d"] * 2
        return acc + F.when(x["i"] % 2 == 0, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(x["d"])

    numbered = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i"))
    )
    return ((F.lit(10) - F.aggregate(numbered, start, add) % 10) % 10).cast("string")


def _card(value: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        body = F.substring(digits, F.lit(1), F.length(digits) - 1)

        def halves(body: Column) -> Column:
            n = F.floor(F.length(body) / 2).cast("int")
            m = F.length(body) - n
            ten = lambda k: F.pow(F.lit(10), k).cast("long")
            pair = feistel(F.substring(body, F.lit(1), n), F.substring(body, n + 1, m), ten(n), ten(m), key, "card")
            new = _let(pair, lambda p: F.concat(_padded(p["l"], n), _padded(p["r"], m)))
            return _let(new, lambda d: F.concat(d, luhn_digit(d)))

        valid = (F.right(digits, F.lit(1)) == luhn_digit(body)) & ~digits.rlike("^0+$")
        return F.when(valid, _refilled(value, _let(body, halves)))

    return _let(_digits(value), of)


def _phone(value: Column, key: str) -> Column:
    """Numbers of the North American plan stay in it; of others all but the country code is permuted."""

    def of(digits: Column) -> Column:
        count = F.length(digits)
        plan = digits.rlike("^1?[2-9][0-9]{2}[2-9][0-9]{6}$") & (~value.startswith("+") | value.rlike(r"^\+1(?!\d{2}[ .(-])"))
        own = F.right(digits, F.lit(10))
        area, rest = F.substring(own, 1, 3).cast("long") - 200, F.substring(own, 4, 7).cast("long") - 2_000_000
        north = _let(
            feistel(area, rest, F.lit(800), F.lit(8_000_000), key, "phone"),
            lambda p: F.concat(F.substring(digits, F.lit(1), count - 10), (p["l"] + 200).cast("string"), (p["r"] + 2_000_000).cast("string")),
        )
        code = F.length(F.regexp_replace(F.regexp_extract(value, r"^\+\d{1,3}(?=[ .(-])", 0), r"\+", ""))
        tail = F.substring(digits, code + 1, count)
        n = F.floor(F.length(tail) / 2).cast("int")
        m = F.length(tail) - n
        ten = lambda k: F.pow(F.lit(10), k).cast("long")
        other = _let(
            feistel(F.substring(tail, F.lit(1), n), F.substring(tail, n + 1, m), ten(n), ten(m), key, "number"),
            lambda p: F.concat(F.substring(digits, F.lit(1), code), _padded(p["l"], n), _padded(p["r"], m)),
        )
        valid = count.between(9, 15)
        return F.when(valid & plan, _refilled(value, north)).when(valid, _refilled(value, other))

    return _let(_digits(value), of)


def _ipv4(value: Column, key: str) -> Column:
    def of(parts: Column) -> Column:
        part = lambda k: F.element_at(parts, k).cast("long")
        valid = ~F.exists(parts, lambda p: (p.cast("long") > 255) | p.rlike("^0[0-9]"))
        pair = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), F.lit(65536), F.lit(65536), key, "ipv4")
        low, high = lambda x: x % 256, lambda x: F.floor(x / 256)
        text = _let(pair, lambda p: F.concat_ws(".", *(x.cast("string") for x in (high(p["l"]), low(p["l"]), high(p["r"]), low(p["r"])))))
        return F.when(valid, text)

    return _let(F.split(value, r"\."), of)


def _ssn(value: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        area, group, serial = (F.substring(digits, *at).cast("long") for at in ((1, 3), (4, 2), (6, 4)))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        pair = feistel(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")
        new = _let(
            pair,
            lambda p: F.concat(
                _padded(p["l"] + F.when(p["l"] >= 665, 2).otherwise(1), 3), _padded(F.floor(p["r"] / 9999) + 1, 2), _padded(p["r"] % 9999 + 1, 4)
            ),
        )
        return F.when(valid, _refilled(value, new))

    return _let(_digits(value), of)


def _date(value: Column, key: str) -> Column:
    """Year-month-day, month/day/year and day.month.year between 1900 and 2099.

    With slashes the day comes first only where month first is no date. Such a date's pseudonym is written day first if
    its day is above 12, else month first, so that the same rule reads it as the day that other forms are linked to.
    """
    iso, slash = value.rlike("^\\d{4}-"), value.contains("/")
    parts = F.split(value, r"[-/.]")
    part = lambda k: F.element_at(parts, k)
    year, month, day = (
        F.when(iso, part(a)).when(slash, part(b)).otherwise(part(c)) for a, b, c in ((1, 3, 3), (2, 1, 2), (3, 2, 1))
    )
    named = lambda m, d: F.try_to_date(F.concat_ws("-", year, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    day_first = slash & named(month, day).isNull()

    def of(at: Column) -> Column:
        n = F.datediff(at, F.lit(FIRST_DAY).cast("date"))
        pair = feistel(F.floor(n / DAYS[1]), n % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), key, "date")

        def written(new: Column) -> Column:
            padded = F.length(value) == 10
            pick = lambda long, short: F.when(padded, F.date_format(new, long)).otherwise(F.date_format(new, short))
            return (
                F.when(iso, F.date_format(new, "yyyy-MM-dd"))
                .when(day_first & (F.dayofmonth(new) > 12), pick("dd/MM/yyyy", "d/M/yyyy"))
                .when(slash, pick("MM/dd/yyyy", "M/d/yyyy"))
                .otherwise(pick("dd.MM.yyyy", "d.M.yyyy"))
            )

        new = _let(pair, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * DAYS[1] + p["r"]).cast("int")))
        return F.when(at.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), _let(new, written))

    return _let(F.coalesce(named(month, day), F.when(slash, named(day, month))), of)


def _iban_rest(text: Column) -> Column:
    """The remainder by 97 of the digits that the signs stand for."""
    return F.aggregate(
        F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0),
        lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )


def _iban(value: Column, key: str) -> Column:
    bare = F.replace(value, F.lit(" "), F.lit(""))

    def of(bare: Column) -> Column:
        country, own = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.length(bare))
        valid = (_iban_rest(F.concat(own, F.substring(bare, 1, 4))) == 1) & F.length(bare).between(15, 34)
        new = _let(feistel_text(own, key, "iban"), lambda o: F.concat(_padded(98 - _iban_rest(F.concat(o, country, F.lit("00"))), 2), o))
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

        def filled(signs: Column) -> Column:
            def put(acc: Column, sign: Column) -> Column:
                return F.struct(
                    F.concat(acc["out"], F.when(sign == " ", sign).otherwise(F.substring(signs, acc["n"] + 1, F.lit(1)))).alias("out"),
                    (acc["n"] + (sign != " ").cast("int")).alias("n"),
                )

            return F.aggregate(F.filter(F.split(value, ""), lambda c: c != ""), start, put, lambda acc: acc["out"])

        return F.when(valid, _let(F.concat(country, new), filled))

    return _let(bare, of)


def _email(value: Column, key: str) -> Column:
    """The local part and the first label of the domain are permuted in lower case, the rest of the domain stays.

    Capitals stay where they are, so addresses that differ by case alone stay linked.
    """
    own = F.regexp_extract(value, r"^[^@]+@[^.]+", 0)
    signs = lambda text: F.filter(F.split(text, ""), lambda c: c != "")
    raised = lambda now, was: F.when(was != F.lower(was), F.upper(now)).otherwise(now)

    def of(o: Column) -> Column:
        moved = F.array_join(F.zip_with(signs(feistel_text(F.lower(o), key, "email")), signs(o), raised), "")
        return F.concat(moved, F.substring(value, F.length(o) + 1, F.length(value)))

    return _let(own, of)


def checked_key(key: str | None) -> str:
    """``key``; raises ValueError if it is missing or short, as whoever guesses it can undo every pseudonym."""
    if not key or len(key) < LEAST_KEY:
        raise ValueError(f"pseudonyms take a secret key of at least {LEAST_KEY} signs, for instance from {KEY_SETTING}")
    return key


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a candidate, null if it isn't valid. A card that isn't one may still be a phone number."""
    kinds = [(EMAIL, _email), (IPV4, _ipv4), (IBAN, _iban), (DATE, _date), (SSN, _ssn), (CARD, _card)]
    out = None
    for pattern, make in kinds:
        is_kind = value.rlike(f"^(?:{pattern})$")
        out = F.when(is_kind, make(value, key)) if out is None else out.when(is_kind, make(value, key))
    return out.otherwise(_phone(value, key))


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text, n_values, pseudonyms for every row of ``docs``.

    ``text`` is the text with each valid value replaced, null where it was null; ``pseudonyms`` lists them in order.
    Candidates that aren't valid and everything else stay. Only doc_id and text are read; repeated rows are each done,
    an empty table gives none. ``key`` is the caller's secret (``checked_key``).
    """
    key = checked_key(key)
    text = F.col("text").cast("string")
    some = F.col("text").rlike("[0-9@]")
    rows = docs.select("doc_id", text.alias("text"))
    found = rows.withColumn("_found", F.when(some, F.regexp_extract_all("text", F.lit(ANY), F.lit(0))))
    made = found.withColumn(
        "_made", F.when(F.size("_found") > 0, F.transform("_found", lambda v: F.struct(v.alias("was"), pseudonym(v, key).alias("now"))))
    )
    between = F.split("text", ANY, -1)
    put = F.array_join(
        F.zip_with(between, "_made", lambda part, m: F.concat(part, F.coalesce(m["now"], m["was"], F.lit("")))), ""
    )
    names = F.filter(F.transform("_made", lambda m: m["now"]), lambda v: v.isNotNull())
    return made.select(
        "doc_id", F.when(F.size("_made") > 0, put).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size(F.coalesce(names, F.array().cast("array<string>"))), F.lit(0)).cast("long").alias("n_values"),
        F.coalesce(names, F.array().cast("array<string>")).alias("pseudonyms"),
    )
