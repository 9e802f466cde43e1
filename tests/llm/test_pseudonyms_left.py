"""Values that a look-alike before them, blanks or a time kept in clear text; shapes are written out here."""

import re

import pytest
from millrace.llm import pseudonyms

CARD, AMEX = "4111 1111 1111 1111", "3782 822463 10005"
LONG = "6304 0000 0000 0000 000"
CASES = [
    ("12/2026 4111 1111 1111 1111", [CARD], ["card"]),
    ("1234 4111 1111 1111 1111 5678", [CARD], ["card"]),
    ("0000 1234 4111-1111-1111-1111, 9999 3782 822463 10005.", ["4111-1111-1111-1111", AMEX], ["card", "card"]),
    ("+49 1234 4111 1111 1111 1111", [CARD], ["card"]),
    ("pay GB82 WEST 1234 5698 7654 32 now", ["GB82 WEST 1234 5698 7654 32"], ["iban"]),
    ("GB82WEST12345698765432", ["GB82WEST12345698765432"], ["iban"]),
    ("DE89 3704 0044 0532 0130 00 AN BANK", ["DE89 3704 0044 0532 0130 00"], ["iban"]),
    ("ES91 2100 0418 4502 0005 1332 IN CASE", ["ES91 2100 0418 4502 0005 1332"], ["iban"]),
    ("NO93 8601 1117 947", ["NO93 8601 1117 947"], ["iban"]),
    ("AB12 4111 1111 1111 1111", [CARD], ["card"]),
    ("at 2024-01-05T10:00:00Z and 2024-01-05", ["2024-01-05"], ["date", "date"]),
    ("2024-01-05Thursday 4111 1111 1111 1112 GB82 WEST 1234 5698 7654 33", [], []),
    ("\U0001f600é4 1234 " + CARD + " \U0001f600", [CARD], ["card"]),
    (f"card {LONG} end", [LONG], ["card"]),
    (f"{CARD} 123 3056 930902 5904 4111.1111.1111.1111", [CARD, "3056 930902 5904", "4111.1111.1111.1111"], ["card"] * 3),
    ("gb82west12345698765432 2024.01.05", ["gb82west12345698765432", "2024.01.05"], ["iban", "date"]),
    ("555.123.4567, +33 1 23 45 67 89 and 123 45 6789", ["555.123.4567", "33 1 23 45 67 89", "123 45 6789"], ["phone", "phone", "ssn"]),
    (f"1234 {CARD} 2024-02-03T1 " * 700, [CARD, "2024-02-03"], ["card", "date"] * 700),
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "doc_id bigint, text string").coalesce(2)
    return {r.doc_id: r for r in pseudonyms.pseudonymise(df, "k", counts="kinds").collect()}


def _luhn(text):
    digits = [int(c) for c in reversed(text) if c.isdigit()]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


@pytest.mark.parametrize("i", range(len(CASES)))
def test_nothing_valid_is_left(rows, i):
    text, values, kinds = CASES[i]
    assert rows[i].kinds == kinds
    assert not any(v in rows[i].text for v in values)
    pattern, at = "", 0
    for m in re.finditer("|".join(map(re.escape, values)) or "(?!)", text):
        shape = re.sub("[A-Z]", "[A-Z]", re.sub("[a-z]", "[a-z]", re.sub("[0-9]", "[0-9]", m.group()).replace("[0-9]", "\0")).replace("\0", "[0-9]"))
        pattern, at = pattern + re.escape(text[at : m.start()]) + f"({shape})", m.end()
    assert (found := re.fullmatch(pattern + re.escape(text[at:]), rows[i].text))
    for new, kind in zip(found.groups(), kinds):
        if kind == "card":
            assert _luhn(new)
        if kind == "iban":
            bare = new.replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def test_blanks_do_not_change_the_pseudonym(rows):
    assert rows[4].text == f"pay {' '.join(re.findall('.{1,4}', rows[5].text))} now"
    one, two = re.findall(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", rows[10].text)
    assert one == two and f"{one}T10:00:00Z" in rows[10].text
