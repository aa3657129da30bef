"""Format-preserving pseudonyms for personal data, as SQL expressions only.

Every value that passes its check is replaced by a keyed permutation of itself within its own
format: equal values get equal pseudonyms in every document, different values different ones, and
a pseudonym passes the same check. Numbers are split in two parts, each taken modulo its own size,
that mask each other for ``ROUNDS`` rounds (a Feistel network whose round function is SHA-256).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Days of a Gregorian cycle of 400 years, 189 * 773; dates are permuted within their cycle.
CYCLE_DAYS = 146097
_CYCLE_PARTS = 189, 773

#: Names of any length; a domain has at most 126 parts of 63 characters.
EMAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}"
IBAN = r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
#: Country codes as the ITU gives them; all that are not of one or two digits have three.
COUNTRY = r"(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
#: The grouping 3-3-4, or 8 to 15 digits with single separators, of which one group may be in parentheses.
PHONE = (
    r"(?<![\w+])\+(?:[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[1-9](?:[ .-]?[0-9]){7,14}"
    r"|[1-9][0-9]{0,2}[ .-]?(?:\([0-9]\)(?:[ .-]?[0-9]){6,11}|\([0-9]{2,4}\)(?:[ .-]?[0-9]){5,8}))(?![0-9])"
)
CARD = r"(?<![\w.-])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\w-]|\.[0-9])"
ADDRESS = r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])"
SOCIAL = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
DATE = r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![\w/-]|\.[0-9])"
ACCESS = r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)"
SECRET = r"(?<=(?i:token|password|passwd|secret|api_key|apikey)[\"']{0,1}[ ]{0,1}[=:][ ]{0,1}[\"']{0,1})[A-Za-z0-9_-]{8,}+"
PATTERN = "|".join([EMAIL, PHONE, DATE, SOCIAL, CARD, IBAN, ADDRESS, ACCESS, SECRET])


def _number(key: str, *parts: Column) -> Column:
    """60 pseudo-random bits of the parts under the key."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def permuted(key: str, kind: str, high: Column, low: Column, highs: Column, lows: Column) -> Column:
    """``struct(high, low)`` permuted within ``highs`` by ``lows`` values."""
    start = F.struct(high.cast("bigint").alias("high"), low.cast("bigint").alias("low"))

    def turn(state: Column, i: Column) -> Column:
        new_high = F.when(
            i % 2 == 0, F.pmod(state["high"] + _number(key, F.lit(kind), lows, i, state["low"]) % highs, highs)
        ).otherwise(state["high"])
        new_low = F.when(
            i % 2 == 1, F.pmod(state["low"] + _number(key, F.lit(kind), highs, i, state["high"]) % lows, lows)
        ).otherwise(state["low"])
        return F.struct(new_high.alias("high"), new_low.alias("low"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _with(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order by ``digits``, as many."""
    spots = F.sequence(F.lit(1), F.length(value))
    one = lambda i: F.substring(value, i, F.lit(1))
    nth = lambda i: F.length(_digits(F.substring(value, F.lit(1), i)))
    return F.array_join(
        F.transform(spots, lambda i: F.when(one(i).rlike("[0-9]"), F.substring(digits, nth(i), F.lit(1))).otherwise(one(i))), ""
    )


def _digit_run(key: str, kind: str, digits: Column) -> Column:
    """Decimal digits, up to 36 of them and at least 2, permuted among those of the same length."""
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    size = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("bigint")
    state = permuted(key, kind, F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, rest), size(half), size(rest))
    return _with(
        state, lambda s: F.concat(F.lpad(s["high"].cast("string"), half, "0"), F.lpad(s["low"].cast("string"), rest, "0"))
    )


def _luhn_sum(payload: Column) -> Column:
    """Luhn sum of digits that a check digit follows."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(payload, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when((n - i) % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _check_digit(payload: Column) -> Column:
    return ((10 - _luhn_sum(payload) % 10) % 10).cast("string")


def _card(key: str, value: Column) -> Column:
    def of_digits(digits: Column) -> Column:
        payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
        new = _with(_digit_run(key, "card", payload), lambda p: F.concat(p, _check_digit(p)))
        valid = _check_digit(payload) == F.substring(digits, F.length(digits), F.lit(1))
        # All zeros and the like are no numbers of anyone.
        return F.when(valid & ~digits.rlike(r"^([0-9])\1*$"), _refilled(value, new)).otherwise(value)

    return _with(_digits(value), of_digits)


def _mod97(text: Column) -> Column:
    """Letters count as two digits, from A = 10 on."""
    step = lambda r, c: F.when(c.rlike("[0-9]"), r * 10 + F.ascii(c) - 48).otherwise(r * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _iban(key: str, value: Column) -> Column:
    """The account changes within its letters and digits, the country stays, the two check digits follow."""

    def of_plain(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))

        def checked(new: Column) -> Column:
            digits = F.lpad((F.lit(98) - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
            whole = F.concat(country, digits, new)
            # Spaces, if any, stand after every fourth character.
            return F.when(value.contains(" "), F.trim(F.regexp_replace(whole, "(.{4})", "$1 "))).otherwise(whole)

        valid = _mod97(F.concat(account, F.substring(plain, 1, 4))) == 1
        return F.when(valid, _with(_symbols(key, "iban", account, sixteens=False), checked)).otherwise(value)

    even = ~value.contains(" ") | value.rlike(r"\A(?:\w{4} )+\w{1,4}\z")
    return F.when(even, _with(F.replace(value, F.lit(" "), F.lit("")), of_plain)).otherwise(value)


def _phone(key: str, value: Column) -> Column:
    """The digits after the country code change."""

    def of_digits(digits: Column) -> Column:
        national = F.regexp_replace(digits, f"^{COUNTRY}", "")
        code = F.substring(digits, F.lit(1), F.length(digits) - F.length(national))
        return _refilled(value, F.concat(code, _with(national, lambda n: _digit_run(key, "phone", n))))

    return _with(_digits(value), of_digits)


def _address(key: str, value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("bigint"))
    side = F.lit(65536).cast("bigint")

    def of_parts(p: Column) -> Column:
        new = permuted(key, "address", p[0] * 256 + p[1], p[2] * 256 + p[3], side, side)
        dotted = _with(
            new,
            lambda s: F.concat_ws(
                ".", *[x.cast("string") for h in ("high", "low") for x in (F.shiftright(s[h], 8), s[h] % 256)]
            ),
        )
        return F.when(F.forall(p, lambda x: x <= 255), dotted).otherwise(value)

    return _with(parts, of_parts)


def _social(key: str, value: Column) -> Column:
    """Areas 001-899 but 666, groups 01-99 and serials 0001-9999, as area and group by serial."""

    def of_parts(p: Column) -> Column:
        area = p[0] - F.when(p[0] > 666, 2).otherwise(1)
        new = permuted(key, "social", area * 99 + p[1] - 1, p[2] - 1, F.lit(898 * 99), F.lit(9999))
        fmt = lambda x, n: F.lpad(x.cast("string"), n, "0")

        def text(s: Column) -> Column:
            number = F.floor(s["high"] / 99)
            number = number + F.when(number >= 665, 2).otherwise(1)
            return F.concat_ws("-", fmt(number, 3), fmt(s["high"] % 99 + 1, 2), fmt(s["low"] + 1, 4))

        valid = p[0].between(1, 899) & (p[0] != 666) & (p[1] > 0) & (p[2] > 0)
        return F.when(valid, _with(new, text)).otherwise(value)

    return _with(F.transform(F.split(value, "-"), lambda x: x.cast("bigint")), of_parts)


def _date(key: str, value: Column) -> Column:
    """Dates of the years 1 to 9600 that exist, in any of the three formats; slashes mean month first."""
    part = lambda *at: F.substring(value, *at).cast("int")
    iso, dots = value.contains("-"), value.contains(".")
    year = F.when(iso, part(1, 4)).otherwise(part(7, 4))
    month = F.when(iso, part(6, 2)).when(dots, part(4, 2)).otherwise(part(1, 2))
    day = F.when(iso, part(9, 2)).when(dots, part(1, 2)).otherwise(part(4, 2))
    padded = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    origin = F.lit("0001-01-01").cast("date")

    def of_date(date: Column) -> Column:
        days = F.datediff(date, origin)
        cycle = F.floor(days / CYCLE_DAYS)
        within = days % CYCLE_DAYS
        highs, lows = (F.lit(x).cast("bigint") for x in _CYCLE_PARTS)
        new = permuted(key, "date", F.floor(within / _CYCLE_PARTS[1]), within % _CYCLE_PARTS[1], highs, lows)

        def text(s: Column) -> Column:
            moved = F.date_add(origin, (cycle * CYCLE_DAYS + s["high"] * _CYCLE_PARTS[1] + s["low"]).cast("int"))
            out = F.when(iso, F.date_format(moved, "yyyy-MM-dd"))
            return out.when(dots, F.date_format(moved, "dd.MM.yyyy")).otherwise(F.date_format(moved, "MM/dd/yyyy"))

        # The years from 9601 on are an unfinished cycle, and years before 1 do not fit the format.
        known = date.between(origin, F.lit("9600-12-31").cast("date"))
        return F.when(known, _with(new, text)).otherwise(value)

    return _with(F.try_to_date(padded, "yyyy-MM-dd"), of_date)


def _symbols(key: str, kind: str, value: Column, sixteens: bool = True) -> Column:
    """Letters and digits permuted within their classes; one half of the text masks the other in turn.

    Hexadecimal text keeps to its sixteen symbols unless ``sixteens`` is off. Everything else stays in place.
    """
    hexadecimal = value.rlike("^[0-9a-f]+$") & F.lit(sixteens)
    n, half = F.length(value), F.floor(F.length(value) / 2).cast("int")
    sixteen = "0123456789abcdef"

    def moved(c: Column, by: Column) -> Column:
        def within(alphabet: str) -> Column:
            at = F.pmod(F.position(c, F.lit(alphabet)) - 1 + by % len(alphabet), F.lit(len(alphabet)))
            return F.substring(F.lit(alphabet), at.cast("int") + 1, F.lit(1))

        return (
            F.when(hexadecimal, within(sixteen))
            .when(c.rlike("[0-9]"), within(sixteen[:10]))
            .when(c.rlike("[a-z]"), within("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("[A-Z]"), within("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .otherwise(c)
        )

    def shifted(side: Column, other: Column, i: Column) -> Column:
        # The other half is hashed once a round, so that long values cost no more than their length.
        mask = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), n.cast("string"), i.cast("string"), other), 256)
        symbols = F.filter(F.split(side, ""), lambda c: c != "")
        return _with(mask, lambda m: F.array_join(F.transform(symbols, lambda c, j: moved(c, _number(key, m, j))), ""))

    def turn(state: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, shifted(state["left"], state["right"], i)).otherwise(state["left"])
        right = F.when(i % 2 == 1, shifted(state["right"], state["left"], i)).otherwise(state["right"])
        return F.struct(left.alias("left"), right.alias("right"))

    start = F.struct(F.substring(value, F.lit(1), half).alias("left"), F.substring(value, half + 1, n - half).alias("right"))
    return _with(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn), lambda s: F.concat(s["left"], s["right"]))


def pseudonym(key: str, value: Column) -> Column:
    """The replacement of one matched value; the value itself if its check fails."""
    whole = lambda p: value.rlike(rf"\A(?:{p})\z")
    at = F.position(F.lit("@"), value)
    return (
        F.when(at > 0, F.concat(_symbols(key, "email", F.substring(value, F.lit(1), at - 1)), F.substring(value, at, F.length(value))))
        .when(value.startswith("+"), _phone(key, value))
        .when(whole(DATE), _date(key, value))
        .when(whole(SOCIAL), _social(key, value))
        .when(whole(ADDRESS), _address(key, value))
        .when(whole(CARD), _card(key, value))
        .when(whole(IBAN), _iban(key, value))
        .when(whole(ACCESS), F.concat(F.lit("AKIA"), _symbols(key, "access", F.substring(value, 5, 16))))
        .otherwise(_symbols(key, "secret", value))
    )


def pseudonymise(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``df`` with personal data in ``text_col`` replaced, and ``n_replaced``, the number of values changed.

    E-mail addresses (the name before the @), phone numbers with + and a country code (8 to 15
    digits), payment card numbers (Luhn), bank accounts (IBAN, check digits by mod 97, spaces after every fourth character or none),
    IPv4 addresses, social security numbers, calendar dates of the years 1 to 9600, access keys and values given to a
    password, token or secret (letters, digits, ``_`` and ``-``, in quotes or not). Values have any length. Phone numbers
    without a country code, IPv6 addresses and values with other characters are not looked for. Texts without such a value, null and empty ones stay as they are, with
    0 replaced; everything but the values stays. Rows are independent, so repeated rows give equal
    results. An input column ``n_replaced`` is replaced.
    """
    names = [c for c in df.columns if c != "n_replaced"]
    text = F.col(f"`{text_col}`")
    found = F.when(text.rlike("[0-9@=:]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    rows = df.select(*[f"`{c}`" for c in names], found.alias("_pii_found"))
    # Without a match no other expression runs.
    found = F.col("_pii_found")
    rows = rows.withColumn("_pii_new", F.when(F.size(found) > 0, F.transform(found, lambda v: pseudonym(key, v))))
    pieces, new = F.split(text, PATTERN, -1), F.col("_pii_new")
    joined = F.array_join(F.zip_with(pieces, new, lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")
    changed = F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x))
    return rows.withColumn("n_replaced", F.when(new.isNull(), 0).otherwise(changed).cast("long")).withColumn(
        text_col, F.when(new.isNull(), text).otherwise(joined)
    ).select(*[f"`{c}`" for c in names], "n_replaced")
