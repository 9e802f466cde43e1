"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import col

ROUNDS = 10

_START, _END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|\d?\d)"
#: Shapes in the order in which they are tried at a place.  The look-behinds and bounded
#: or possessive repeats keep the search linear in the text.
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}" + _END,
    "iban": _START
    + "(?:"
    + r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
    + r"|[a-z]{2}\d{2}(?:[a-z0-9]{11,30}|(?: [a-z0-9]{4}){2,7}(?: [a-z0-9]{1,3})?)"
    + ")"
    + _END,
    "date": _START
    + "(?:"
    + r"\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{4}\.\d{1,2}\.\d{1,2}"
    + r"|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4}"
    + ")"
    + r"(?:(?=[Tt]\d)|"  # a time may follow
    + _END
    + r")(?![./-]?\d)",
    "ip": r"(?<![\p{L}\p{N}_.])" + rf"(?:{_OCTET}\.){{3}}{_OCTET}" + _END + r"(?!\.\d)",
    "ssn": _START
    + r"(?!000|666|9)(?:\d{3}-(?!00)\d{2}-(?!0000)\d{4}|\d{3} (?!00)\d{2} (?!0000)\d{4})"
    + _END
    + r"(?!-\d)",
    "phone": r"(?<![\p{L}\p{N}_+])"
    + "(?:"
    + r"\+\d{1,3}[ .-]\d{1,2}(?:[ .-]\d{2}){4}"
    + r"|\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}"
    + r"|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}"
    + ")"
    + _END,
    "card": _START
    + "(?:"
    + r"\d{4}(?: \d{4}){3} \d{1,3}|\d{4}(?:-\d{4}){3}-\d{1,3}|\d{4}(?:\.\d{4}){3}\.\d{1,3}"
    + r"|\d{4}(?: \d{4}){2} \d{1,7}|\d{4}(?:-\d{4}){2}-\d{1,7}|\d{4}(?:\.\d{4}){2}\.\d{1,7}"
    + r"|\d{4} \d{6} \d{4,5}|\d{4}-\d{6}-\d{4,5}|\d{4}\.\d{6}\.\d{4,5}|\d{13,19}"
    + ")"
    + _END,
}
PATTERN = "|".join(f"(?:{shape})" for shape in SHAPES.values())

#: Dates are permuted within 49 cycles of four years, 1904 to 2099.
FIRST_DAY, FIRST_YEAR, LAST_YEAR = "1904-01-01", 1904, 2099
DAYS = (147, 487)


def _long(value) -> Column:
    return F.lit(value).cast("bigint")


def _quotient(a, b) -> Column:
    return F.call_function("div", a, b)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use).getItem(0)


def _digest(key: str, *parts) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)


def permuted(value: Column, high, low, key: str, tweak: str) -> Column:
    """A permutation of 0 .. high * low - 1: alternating Feistel over (mod high, mod low)."""
    high, low = (x if isinstance(x, Column) else _long(x) for x in (high, low))

    def step(state, i):
        moved = F.conv(F.substring(_digest(key, F.lit(tweak), i, state["y"]), 1, 15), 16, 10).cast("bigint")
        # One half is moved by the other, which then moves in its turn.
        return F.struct(
            state["y"].alias("x"),
            F.pmod(state["x"] + moved, state["m"]).alias("y"),
            state["n"].alias("m"),
            state["m"].alias("n"),
        )

    start = F.struct(
        _quotient(value, low).alias("x"), F.pmod(value, low).alias("y"), high.alias("m"), low.alias("n")
    )
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, step, lambda s: s["x"] * low + s["y"])


def _power(digits: Column) -> Column:
    return F.pow(F.lit(10.0), digits).cast("bigint")


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _refilled(shape: Column, digits: Column) -> Column:
    """The shape with its digits replaced in order."""

    def put(state, c, digits):
        at = state["at"]
        is_digit = c.rlike("^[0-9]$")
        return F.struct(
            (at + is_digit.cast("int")).alias("at"),
            F.concat(state["out"], F.when(is_digit, digits.substr(at, F.lit(1))).otherwise(c)).alias("out"),
        )

    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    return _bound(digits, lambda new: F.aggregate(_characters(shape), start, lambda s, c: put(s, c, new), lambda s: s["out"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _digit_string(value: Column, length: Column) -> Column:
    return F.lpad(value.cast("string"), length, F.lit("0"))


def _permuted_digits(digits: Column, key: str, tweak: str) -> Column:
    n = F.length(digits)
    low = _quotient(n, F.lit(2)).cast("int")
    moved = permuted(digits.cast("bigint"), _power(n - low), _power(low), key, tweak)
    return _digit_string(moved, n)


def _luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Sum from the right; the last digit is doubled or not."""
    n = F.length(digits)

    def add(total, i):
        digit = digits.substr(n - i, F.lit(1)).cast("int")
        double = (i % 2 == 0) if doubled_first else (i % 2 == 1)
        twice = digit * 2
        return total + F.when(double, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _is_card(m: Column) -> Column:
    return _bound(_digits(m), lambda d: F.length(d).between(13, 19) & (_luhn_sum(d, False) % 10 == 0))


def _card_within(m: Column) -> Column:
    """The match, or its first four groups of four if only they are a card number; null if neither is."""
    first = m.substr(F.lit(1), F.lit(19))
    five = m.rlike(r"^\d{4}(?:[ .-]\d{4}){3}[ .-]\d{1,3}$")
    return F.when(_is_card(m), m).when(five & _is_card(first), first)


def _card(m: Column, key: str) -> Column:
    digits = _digits(m)

    def checked(payload):
        check = F.pmod(10 - _luhn_sum(payload, True) % 10, F.lit(10)).cast("string")
        return F.concat(payload, check)

    payload = _permuted_digits(digits.substr(F.lit(1), F.length(digits) - 1), key, "card")
    # `_card_within` has checked it.
    return _refilled(m, _bound(payload, checked))


def _phone(m: Column, key: str) -> Column:
    digits = _digits(m)
    n = F.length(digits)
    own = F.least(n, F.lit(10))
    moved = _permuted_digits(digits.substr(n - own + 1, own), key, "phone")
    return F.when(n.between(8, 15), _refilled(m, F.concat(digits.substr(F.lit(1), n - own), moved)))


def _ip(m: Column, key: str) -> Column:
    octet = [F.split_part(m, F.lit("."), F.lit(i)).cast("bigint") for i in range(1, 5)]
    value = octet[0] * (1 << 24) + octet[1] * (1 << 16) + octet[2] * (1 << 8) + octet[3]
    moved = permuted(value, 1 << 16, 1 << 16, key, "ip")
    places = [1 << 24, 1 << 16, 1 << 8, 1]
    return _bound(moved, lambda v: F.concat_ws(".", *[F.pmod(_quotient(v, _long(p)), _long(256)).cast("string") for p in places]))


def _ssn(m: Column, key: str) -> Column:
    separator = m.substr(F.lit(4), F.lit(1))
    area, group, serial = (F.split_part(m, separator, F.lit(i)).cast("bigint") for i in (1, 2, 3))
    rank = area - 1 - (area > 666).cast("bigint")
    value = (rank * 99 + group - 1) * 9999 + serial - 1

    def written(v):
        place = _quotient(v, _long(99 * 9999)) + 1
        rest = F.pmod(v, _long(99 * 9999))
        return F.concat(
            _digit_string(place + (place >= 666).cast("bigint"), F.lit(3)),
            separator,
            _digit_string(_quotient(rest, _long(9999)) + 1, F.lit(2)),
            separator,
            _digit_string(F.pmod(rest, _long(9999)) + 1, F.lit(4)),
        )

    return _bound(permuted(value, 898, 99 * 9999, key, "ssn"), written)


def _date(m: Column, key: str) -> Column:
    parts = F.split(m, "[./-]")
    first, second, third = (parts.getItem(i) for i in range(3))
    year_first = F.length(first) == 4
    slashes = m.contains("/") & ~year_first
    # With slashes the month is read first unless it cannot be one, and always written first.
    month_first = slashes & (first.cast("int") <= 12)
    month = F.when(month_first, first).otherwise(second)
    day = F.when(year_first, third).when(month_first, second).otherwise(first)
    year = F.when(year_first, first).otherwise(third)
    padded = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    date = F.try_to_timestamp(padded, F.lit("yyyy-MM-dd")).cast("date")
    separator = F.regexp_extract(m, "[./-]", 0)
    filled = (F.length(first) != 1) & (F.length(second) == 2) & (F.length(third) != 1)

    def written(new):
        def short(part):
            return F.when(filled, F.lpad(part.cast("string"), 2, "0")).otherwise(part.cast("string"))

        y, mm, dd = F.year(new).cast("string"), short(F.month(new)), short(F.day(new))
        return (
            F.when(year_first, F.concat(y, separator, mm, separator, dd))
            .when(slashes, F.concat(mm, separator, dd, separator, y))
            .otherwise(F.concat(dd, separator, mm, separator, y))
        )

    day_number = F.datediff(date, F.lit(FIRST_DAY).cast("date")).cast("bigint")
    moved = F.date_add(F.lit(FIRST_DAY).cast("date"), permuted(day_number, *DAYS, key, "date").cast("int"))
    return F.when(F.year(date).between(FIRST_YEAR, LAST_YEAR), _bound(moved, written))


def _moved_characters(text: Column, key: str, tweak: str) -> Column:
    """Permute a text whose letters stay letters, digits digits, and the rest itself."""
    n = F.length(text)
    half = _quotient(n, F.lit(2)).cast("int")

    def shifted(part, other, i):
        def move(c, at):
            stream = _digest(key, F.lit(tweak), i, _quotient(at, F.lit(32)), other)
            by = F.conv(stream.substr(at % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
            code = F.ascii(c)
            return (
                F.when(c.rlike("^[a-z]$"), F.char(F.pmod(code - 97 + by, F.lit(26)) + 97))
                .when(c.rlike("^[A-Z]$"), F.char(F.pmod(code - 65 + by, F.lit(26)) + 65))
                .when(c.rlike("^[0-9]$"), F.char(F.pmod(code - 48 + by, F.lit(10)) + 48))
                .otherwise(c)
            )

        return F.array_join(F.transform(_characters(part), move), "")

    def step(state, i):
        return F.struct(state["y"].alias("x"), shifted(state["x"], state["y"], i).alias("y"))

    start = F.struct(text.substr(F.lit(1), half).alias("x"), text.substr(half + 1, n - half).alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["x"], s["y"]))


def _email(m: Column, key: str) -> Column:
    lower = F.lower(m)
    name, ending = F.regexp_extract(lower, r"^(.*)\.[a-z]+$", 1), F.regexp_extract(lower, r"\.[a-z]+$", 0)
    return F.concat(_moved_characters(name, key, "email"), ending)


def _mod97(text: Column) -> Column:
    """Value of digits and letters (A is 10) modulo 97."""

    def add(total, c):
        code = F.ascii(c)
        return F.when(code < 58, (total * 10 + code - 48) % 97).otherwise((total * 100 + code - 55) % 97)

    return F.aggregate(_characters(text), F.lit(0), add)


def _iban_within(m: Column) -> Column:
    """The longest run of the match's groups, from its first, that is an IBAN; null if none is."""

    def valid(text):
        def rotated(bare):
            whole = F.concat(bare.substr(F.lit(5), F.length(bare)), bare.substr(F.lit(1), F.lit(4)))
            return F.length(bare).between(15, 34) & (_mod97(whole) == 1)

        return _bound(F.upper(F.replace(text, F.lit(" "))), rotated)

    def runs(groups):
        return F.transform(
            F.sequence(F.size(groups), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(groups, F.lit(1), n), " ")
        )

    return F.get(F.filter(_bound(F.split(m, " "), runs), valid), F.lit(0))


def _iban(m: Column, key: str) -> Column:
    bare = F.upper(F.replace(m, F.lit(" ")))
    country, account = bare.substr(F.lit(1), F.lit(2)), bare.substr(F.lit(5), F.length(bare))

    def checked(new):
        check = 98 - _mod97(F.concat(new, country, F.lit("00")))
        whole = F.concat(country, F.lpad(check.cast("string"), 2, "0"), new)
        cased = F.when(m.rlike("^[a-z]"), F.lower(whole)).otherwise(whole)
        return F.when(m.contains(" "), F.regexp_replace(cased, "(.{4})(?=.)", "$1 ")).otherwise(cased)

    # `_iban_within` has checked it.
    return _bound(_moved_characters(account, key, "iban"), checked)


RULES: dict[str, Callable[[Column, str], Column]] = {
    "email": _email,
    "iban": _iban,
    "date": _date,
    "ip": _ip,
    "ssn": _ssn,
    "phone": _phone,
    "card": _card,
}


#: Candidates that are joined at a time, so that a long text is not copied for each of them.
BLOCK = 256


def _replaced(m: Column, key: str) -> Column:
    """Kind of a candidate, the value in its place (null if it fails its check), and how much of it that covers."""
    kind = F.lit(None).cast("string")
    for name in reversed(SHAPES):
        kind = F.when(m.rlike(f"^(?:{SHAPES[name]})$"), F.lit(name)).otherwise(kind)

    def moved(k):
        def ruled(own):
            new = F.lit(None).cast("string")
            for name, rule in RULES.items():
                new = F.when(k == name, rule(own, key)).otherwise(new)
            return F.struct(k.alias("kind"), new.alias("value"), F.length(own).alias("covers"))

        return _bound(F.when(k == "iban", _iban_within(m)).when(k == "card", _card_within(m)).otherwise(m), ruled)

    return _bound(kind, moved)


def _joined(items: Column) -> Column:
    """The text of (``piece``, ``found``) items in a row, and the kinds of the replaced values.

    A piece begins with its candidate and ends where the next begins.  ``skip`` counts the
    characters still covered by the last replaced value; candidates that begin there are
    passed over, while those inside a candidate that failed its check are tried.
    """
    empty = F.array().cast("array<string>")

    def put(state, item):
        piece, found = item["piece"], item["found"]
        take = (state["skip"] == 0) & found["value"].isNotNull()
        gone = F.when(take, found["covers"]).otherwise(state["skip"])
        return F.struct(
            F.greatest(gone - F.length(piece), F.lit(0)).alias("skip"),
            F.concat(state["text"], F.when(take, found["value"]).otherwise(""), piece.substr(gone + 1, F.length(piece))).alias("text"),
            F.when(take, F.concat(state["kinds"], F.array(found["kind"]))).otherwise(state["kinds"]).alias("kinds"),
        )

    def put_block(state, first):
        start = F.struct(state["skip"].alias("skip"), F.lit("").alias("text"), empty.alias("kinds"))
        block = F.aggregate(F.slice(items, first, F.lit(BLOCK)), start, put)
        return _bound(
            block,
            lambda b: F.struct(
                b["skip"].alias("skip"),
                F.concat(state["texts"], F.array(b["text"])).alias("texts"),
                F.concat(state["kinds"], F.array(b["kinds"])).alias("kinds"),
            ),
        )

    start = F.struct(F.lit(0).alias("skip"), empty.alias("texts"), F.array().cast("array<array<string>>").alias("kinds"))
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), F.lit(BLOCK)),
        start,
        put_block,
        lambda s: F.struct(F.array_join(s["texts"], "").alias("text"), F.flatten(s["kinds"]).alias("kinds")),
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", counts: str | None = None) -> DataFrame:
    """The documents with personal data in the text replaced by pseudonyms.

    Replaced are values in these formats:

    * e-mail and IPv4 addresses
    * IBANs, checked modulo 97: in one word or in groups of four, all letters of one case
    * dates, real days of 1904 to 2099: ``2024-01-05``, ``2024/01/05``, ``2024.01.05``, ``05.01.2024``,
      ``05-01-2024``, ``01/05/2024``, leading zeros or not; ``T`` and a time may follow
    * US social security numbers of areas that can be issued: ``123-45-6789``, ``123 45 6789``
    * telephone numbers of 8 to 15 digits: ``+`` and a country code with groups of two to four
      digits or of pairs, parted by blank, dot, hyphen or nothing; ``(555) 123-4567``,
      ``555-123-4567``, ``555.123.4567``
    * payment cards of 13 to 19 digits, checked by Luhn: in one word, in groups of four with a
      shorter or longer last one, or 4-6-4 and 4-6-5, parted by blanks, hyphens or dots

    They are permuted under ``key`` within their format: digits stay digits, separators stay,
    check digits are made anew, a date becomes a date.  One value gets one pseudonym in all
    documents, in whichever of these formats it is written, and two values never share one.
    Text that has the shape but fails the check is left as it is, and a value that begins
    inside it is still found.  Other notations (numbers in words, other separators) are not.

    ``counts`` names an optional column: an array with the kind of each replaced value.  A
    null text stays null; all other columns are passed on as they are, repeated rows alike, and
    an empty table stays empty.  Rows are handled one by one where they are read, with
    built-in functions only.
    """
    text = col(text_col)
    # Candidates at every place where one begins, and the text cut at these places.
    found = F.transform(F.regexp_extract_all(text, F.lit(f"(?=({PATTERN}))"), F.lit(1)), lambda m: _replaced(m, key))
    cut = F.split(text, f"(?={PATTERN})", -1)

    def worked_out(cut, found):
        # What is before the first candidate is a piece of its own.
        head = F.size(cut) - F.size(found)
        items = F.zip_with(
            F.slice(cut, head + 1, F.size(found)), found, lambda piece, f: F.struct(piece.alias("piece"), f.alias("found"))
        )
        before = F.when(head > 0, cut.getItem(0)).otherwise("")
        joined = _bound(items, _joined)
        return _bound(joined, lambda j: F.struct(F.concat(before, j["text"]).alias("text"), j["kinds"].alias("kinds")))

    spare = "__pseudonyms"
    while spare in docs.columns:
        spare += "_"
    new = _bound(cut, lambda c: _bound(found, lambda f: worked_out(c, f)))
    out = docs.withColumn(spare, F.when(text.rlike("[0-9@]"), new))
    out = out.withColumn(text_col, F.coalesce(F.col(f"`{spare}`.text"), text))
    if counts:
        out = out.withColumn(counts, F.coalesce(F.col(f"`{spare}`.kinds"), F.array().cast("array<string>")))
    return out.drop(spare)
