"""Against a plain Python version of the same permutations."""

import datetime
import hashlib

import pytest
import regex
from millrace.llm import pseudonyms as P
from millrace.llm.queries import DEMO_KEY, op10_pseudonyms
from pyspark.sql import functions as F

KEY = "k"

#: The formats as the docstring lists them, written out here.
B, E = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|0[0-9])"


def grouped(*sizes):
    """Groups of digits with one separator throughout."""
    return "|".join(sep.join(f"[0-9]{{{n}}}" for n in sizes) for sep in (" ", "-", r"\."))


FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}" + E,
    "iban": B + "(?:" + "|".join(rf"{a}{a}[0-9][0-9](?:{c}{{11,30}}|(?: {c}{{4}}){{2,7}}(?: {c}{{1,3}})?)" for a, c in (("[A-Z]", "[A-Z0-9]"), ("[a-z]", "[a-z0-9]"))) + ")" + E,
    "date": B + "(?:" + "|".join(x.replace("y", "[0-9]{4}").replace("n", "[0-9]{1,2}") for x in ("y-n-n", "y/n/n", r"y\.n\.n", r"n\.n\.y", "n/n/y", "n-n-y")) + ")(?:(?=[Tt][0-9])|" + E + ")(?![./-]?[0-9])",
    "ip": r"(?<![\p{L}\p{N}_.])" + r"\.".join([OCTET] * 4) + E + r"(?!\.[0-9])",
    "ssn": B + "(?!000|666|9)(?:[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}|[0-9]{3} (?!00)[0-9]{2} (?!0000)[0-9]{4})" + E + "(?!-[0-9])",
    "phone": r"(?<![\p{L}\p{N}_+])(?:" + "|".join((
        r"\+[0-9]{1,3}[ .-][0-9]{1,2}(?:[ .-][0-9]{2}){4}",
        r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}",
        r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}", "[0-9]{3}-[0-9]{3}-[0-9]{4}", r"[0-9]{3}\.[0-9]{3}\.[0-9]{4}")) + ")" + E,
    "card": B + "(?:" + "|".join((grouped(4, 4, 4, 4, "1,3"), grouped(4, 4, 4, "1,7"), grouped(4, 6, "4,5"), "[0-9]{13,19}")) + ")" + E,
}
SHAPES = {k: regex.compile(v) for k, v in FORMATS.items()}
WHOLE = regex.compile("|".join(f"(?:{v})" for v in FORMATS.values()))


def digest(key, *parts):
    return hashlib.sha256("|".join([key, *map(str, parts)]).encode()).hexdigest()


def permuted(v, a, b, key, tweak):
    x, y = divmod(v, b)
    for i in range(1, P.ROUNDS + 1):
        x, y, a, b = y, (x + int(digest(key, tweak, i, y)[:15], 16)) % a, b, a
    return x * b + y


def permuted_digits(d, key, tweak):
    low = len(d) // 2
    return str(permuted(int(d), 10 ** (len(d) - low), 10**low, key, tweak)).zfill(len(d))


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10


def refill(shape, digits):
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in shape)


def moved_characters(text, key, tweak):
    x, y = text[: len(text) // 2], text[len(text) // 2 :]
    for i in range(1, P.ROUNDS + 1):
        out = ""
        for at, c in enumerate(x):
            by = int(digest(key, tweak, i, at // 32, y)[at % 32 * 2 :][:2], 16)
            for base, size in (("a", 26), ("A", 26), ("0", 10)):
                if ord(base) <= ord(c) < ord(base) + size:
                    c = chr((ord(c) - ord(base) + by) % size + ord(base))
                    break
            out += c
        x, y = y, out
    return x + y


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def pseudonym(kind, m, key):
    digits = regex.sub("[^0-9]", "", m)
    if kind == "card":
        if not 13 <= len(digits) <= 19 or luhn(digits):
            return None
        payload = permuted_digits(digits[:-1], key, "card")
        return refill(m, payload + next(c for c in "0123456789" if luhn(payload + c) == 0))
    if kind == "phone":
        own = min(len(digits), 10)
        return refill(m, digits[:-own] + permuted_digits(digits[-own:], key, "phone")) if 8 <= len(digits) <= 15 else None
    if kind == "ip":
        v = permuted(int.from_bytes(bytes(map(int, m.split("."))), "big"), 1 << 16, 1 << 16, key, "ip")
        return ".".join(map(str, v.to_bytes(4, "big")))
    if kind == "ssn":
        sep = m[3]
        a, g, s = map(int, m.split(sep))
        v = permuted(((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1, 898, 99 * 9999, key, "ssn")
        a, rest = v // (99 * 9999) + 1, v % (99 * 9999)
        return f"{a + (a >= 666):03d}{sep}{rest // 9999 + 1:02d}{sep}{rest % 9999 + 1:04d}"
    if kind == "email":
        name, _, end = m.lower().rpartition(".")
        return moved_characters(name, key, "email") + "." + end
    if kind == "iban":
        bare = m.replace(" ", "").upper()
        if not 15 <= len(bare) <= 34 or mod97(bare[4:] + bare[:4]) != 1:
            return None
        new = moved_characters(bare[4:], key, "iban")
        new = bare[:2] + f"{98 - mod97(new + bare[:2] + '00'):02d}" + new
        new = new.lower() if m[0].islower() else new
        return " ".join(new[i : i + 4] for i in range(0, len(new), 4)) if " " in m else new
    sep = regex.search("[./-]", m).group()
    parts = m.split(sep)
    a, b, c = map(int, parts)
    year_first, slash = len(parts[0]) == 4, sep == "/" and len(parts[0]) != 4
    year, month, day = (a, b, c) if year_first else (c, a, b) if slash and a <= 12 else (c, b, a)
    try:
        date = datetime.date(year, month, day)
    except ValueError:
        return None
    if not 1904 <= year <= 2099:
        return None
    base = datetime.date(1904, 1, 1)
    new = base + datetime.timedelta(permuted((date - base).days, *P.DAYS, key, "date"))
    filled = all(len(p) != 1 for p in parts)
    mm, dd = (f"{x:02d}" if filled else str(x) for x in (new.month, new.day))
    order = [str(new.year), mm, dd] if year_first else [mm, dd, str(new.year)] if slash else [dd, mm, str(new.year)]
    return sep.join(order)


def parts(kind, m):
    """What of a match may be the value, longest first."""
    if kind == "iban":
        return [m[:i] for i in range(len(m), 0, -1) if i == len(m) or m[i] == " "]
    return [m, m[:19]] if kind == "card" and regex.fullmatch(r"[0-9]{4}([ .-][0-9]{4}){3}[ .-][0-9]{1,3}", m) else [m]


def brute(text, key):
    kinds, out, at = [], "", 0
    for match in WHOLE.finditer(text or "", overlapped=True):
        if match.start() < at:
            continue
        kind = next(k for k in SHAPES if SHAPES[k].match(text, match.start()))
        for m in parts(kind, SHAPES[kind].match(text, match.start()).group()):
            new = pseudonym(kind, m, key)
            if new is not None:
                out += text[at : match.start()] + new
                at = match.start() + len(m)
                kinds.append(kind)
                break
    return (None, []) if text is None else (out + text[at:], kinds)


TEXTS = [
    None,
    "",
    "nothing here",
    "call +1 (743) 555-3824, 743-555-3824 or (743) 555-3824 4532015112830366 end",
    "4532015112830366 27.109.211.155. 4532-0151-1283-0366 4532015112830367 3782 822463 10005",
    "Und.34@Mail7.example.com%%% und.34@mail7.example.com, a@b.co x@y @z",
    "GB82WEST12345698765432 GB82WEST12345698765433 DE89370400440532013000",
    "1999-12-31 31.12.1999 12/31/1999 31/12/1999 1.2.2003 2/3/2004 2001-02-30 1850-01-01 1999/12/31 12-31-1999",
    "078-05-1120 000-12-3456 666-12-3456 665-99-9999 667-01-0001 899-99-9999 001-01-0001",
    "256.1.1.1 1.2.3.4.5 0.0.0.0 255.255.255.255 v1.2.3.4 4.0. é12345678901234567 1234567890123456789012",
    "+49 30 1234567 +123 +44 20 7946 0958 " + "a" * 200 + "@x.com " + "9" * 40,
    "x" * 200000 + " 4532015112830366 " + "1" * 100000,
    "4532015112830366\n4532015112830366\t\\$1 +",
    "3056 930902 5904 3056-930902-5904 4111.1111.1111.1111 4111 1111 1111 1111 123 6304 0000 0000 0000 000",
    "gb82west12345698765432 gb82 west 1234 5698 7654 32 Gb82West12345698765432 2024.01.05 2024.1.5",
    "555.123.4567 +33 1 23 45 67 89 +33 1 23 45 67 89 12 123 45 6789 666 12 3456 123 456 789",
    "1234 4111 1111 1111 1111 5678 AB12 4111 1111 1111 1111 at 2024-01-05T10:00:00Z",
]


def test_against_plain_python(spark):
    schema = "doc_id bigint, text string, kind string, `__pseudonyms` int"
    rows = [(i, t, "own", 1) for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(rows, schema)
    out = P.pseudonymise(df, KEY, counts="kinds")
    assert out.columns == ["doc_id", "text", "kind", "__pseudonyms", "kinds"]
    for r in out.collect():
        text, kinds = brute(TEXTS[r.doc_id], KEY)
        assert (r.text, list(r.kinds), r.kind) == (text, kinds, "own")
    assert P.pseudonymise(df.limit(0), KEY).count() == 0


@pytest.mark.parametrize("high,low", [(7, 5), (147, 487)])
def test_a_permutation(spark, high, low):
    v = spark.range(high * low).select(P.permuted(F.col("id"), high, low, KEY, "t").alias("v"))
    assert sorted(r.v for r in v.collect()) == list(range(high * low))


def test_equal_values_stay_linked(spark):
    df = spark.createDataFrame([(0, TEXTS[3]), (1, TEXTS[7])], "doc_id bigint, text string")
    phone, dates = (r.text for r in P.pseudonymise(df, KEY).orderBy("doc_id").collect())
    assert len({regex.sub(r"\D", "", x)[-10:] for x in regex.findall(r"\(?\d{3}\)?[ -]\d{3}-\d{4}", phone)}) == 1
    year = regex.match(r"\d{4}", dates).group()
    assert dates.count(year) >= 4


def test_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op10_pseudonyms(spark, sf_dir)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = found.collect()
    assert len(rows) == len(docs) and sum(r.n_replaced for r in rows) > 0
    for r in rows:
        text, kinds = brute(docs[r.doc_id], DEMO_KEY)
        assert (r.text, r.kinds) == (text, ",".join(kinds))
