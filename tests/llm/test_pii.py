import datetime as dt
import os
import re
import time

import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st

from placelytics.llm import pii
from tests.llm import edge

KEY = b"a key of the tests"

VALUES = {
    "mail": "bosbt.42@mail8.example.com",
    "card": "4041894974608795",
    "phone": "+1 (386) 555-3733",
    "ip": "25.86.162.211",
    "ssn": "123-45-6789",
    "date": "2021-03-31",
    "date_slashed": "31/12/1999",
    "date_dotted": "01.02.2003",
    "iban": "DE89 3704 0044 0532 0130 00",
}


def swapped(value):
    text, n = pii.pseudonymised(f"see {value}, again {value}.", KEY)
    match = re.fullmatch(r"see (.*), again (.*)\.", text)
    assert n == 2 and match[1] == match[2] != value
    return match[1]


@pytest.mark.parametrize("kind", VALUES)
def test_value_keeps_its_format_and_stays_valid(kind):
    value = VALUES[kind]
    new = swapped(value)
    if kind != "ip":
        assert re.sub(r"[a-z]", "a", re.sub(r"\d", "0", new)) == re.sub(r"[a-z]", "a", re.sub(r"\d", "0", value))
    assert swapped(new)
    if kind == "card":
        assert pii.luhn_ok(new) and new[0] == value[0]
    if kind == "date":
        dt.date.fromisoformat(new)


def test_punctuation_does_not_unlink():
    assert re.sub(r"\D", "", swapped("4041 8949 7460 8795")) == swapped("4041894974608795")
    assert re.sub(r"\D", "", swapped("386-555-3733")) == re.sub(r"\D", "", swapped("+1 (386) 555-3733"))[1:]


@pytest.mark.parametrize("text", ["4041894974608796", "1.2.3", "300.1.2.3", "2021-02-30", "version 2.0.1", "plain", "", "123456789012", "a@b"])
def test_invalid_values_stay(text):
    assert pii.pseudonymised(text, KEY) == (text, 0)


@pytest.mark.parametrize(
    "value",
    [
        "+1 (017) 555-7713", "017-555-7713", "211 911 0000", "+44 20 7946 0958", "+44 (207) 946-0958", "+49 30 901820",
        "+33123456789", "+13865553733", "+358 9 1234567", "233.254.104.120", "127.204.92.12", "0.1.2.3", "10.20.30.40",
        "255.255.255.255", "0000 0000 0000 0018", "10.0.0.1", "(111) 111-1111", "000-000-0000", "0000 0000 0000 0000",
    ],
)
def test_every_value_of_the_format_is_replaced(value):
    new = swapped(value)
    if "." not in value:
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", value)
    assert swapped(new) != new
    for country in ("+1 ", "+44 ", "+49 ", "+33", "+358 "):
        assert new.startswith(country) == value.startswith(country)


def test_country_code_does_not_unlink():
    assert re.sub(r"\D", "", swapped("+13865553733")) == re.sub(r"\D", "", swapped("+1 (386) 555-3733"))


def test_no_phone_or_address_of_the_documents_stays():
    table = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(table):
        pytest.skip("no test tables")
    plain = re.compile(r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])")
    seen = 0
    for text in filter(None, pq.read_table(table, columns=["text"])["text"].to_pylist()):
        old = plain.findall(text)
        seen += len(old)
        assert not old or not set(old) & set(plain.findall(pii.pseudonymised(text, KEY)[0]))
    assert seen > 10


CARD = "4111 1111 1111 1111"


@pytest.mark.parametrize(
    "text, values",
    [
        *((f"{CARD} {n}", [CARD]) for n in (124, 125, 7, 12)),
        (f"{CARD}-12/27", [CARD]),
        (f"12 {CARD}", [CARD]),
        ("1234 4111111111111111", ["4111111111111111"]),
        (f"{CARD} 386-555-3733", [CARD, "386-555-3733"]),
        ("386-555-3733 386-555-3734", ["386-555-3733", "386-555-3734"]),
        ("BE68539007547034 EUR", ["BE68539007547034"]),
        ("ES91 2100 0418 4502 0005 1332 EUR", ["ES91 2100 0418 4502 0005 1332"]),
        (f"BE68 5390 0754 7034 {CARD}", ["BE68 5390 0754 7034", CARD]),
        (f"AB12 {CARD}", [CARD]),
        (f"2021-02-30 {CARD}", [CARD]),
        (f"+33 1 23 45 67 89 {CARD}", ["+33 1 23 45 67 89", CARD]),
        ("+44 20 7946 0958 190.137.223.204", ["+44 20 7946 0958", "190.137.223.204"]),
        ("+1 386 555 3733 190 20", ["+1 386 555 3733"]),
    ],
)
def test_values_beside_other_text_are_found(text, values):
    expected = text
    for value in values:
        expected = expected.replace(value, pii.pseudonymised(value, KEY)[0])
    assert pii.pseudonymised(text, KEY) == (expected, len(values))


def test_rows_of_small_numbers_stay():
    text = " ".join(str(i % 31) for i in range(12, 60))
    assert pii.pseudonymised(text, KEY) == (text, 0)


@pytest.mark.parametrize("unit", ["1111 2222 ", "+44 1 ", "AB12 CD34 ", "1", "a.", "1."])
def test_long_runs_take_linear_time(unit):
    def seconds(n):
        text, taken = unit * n, []
        for _ in range(3):
            began = time.perf_counter()
            pii.pseudonymised(text, KEY)
            taken.append(time.perf_counter() - began)
        return min(taken)

    seconds(100)
    # Four times the text: a square would take sixteen times as long.
    assert seconds(20_000) < 9 * seconds(5_000) + 0.05


def plain_scan(text):
    """Values of an independent, plainer scanner: by groups of characters, not by one pattern of all kinds."""
    found = []
    for token in re.findall(r"[0-9A-Za-z@._+-]+", text):
        parts = token.rstrip(".").split(".")
        if len(parts) == 4 and all(p.isdecimal() and len(p) <= 3 and int(p) < 256 for p in parts):
            found.append(token.rstrip("."))
        elif re.fullmatch(r"\d{16}", token):
            doubled = [2 * int(d) if i % 2 == 0 else int(d) for i, d in enumerate(token)]
            if sum(d // 10 + d % 10 for d in doubled) % 10 == 0:
                found.append(token)
        elif re.fullmatch(r"\d{3}-\d{2}-\d{4}", token):
            area, group, serial = map(int, token.split("-"))
            if area not in (0, 666) and area < 900 and group and serial:
                found.append(token)
    return found


def test_every_value_an_independent_scanner_finds_is_replaced_alike():
    table = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(table):
        pytest.skip("no test tables")
    linked = {}
    for text in filter(None, pq.read_table(table, columns=["text"])["text"].to_pylist()):
        old, new = plain_scan(text), plain_scan(pii.pseudonymised(text, KEY)[0])
        assert len(old) == len(new)
        for a, b in zip(old, new, strict=True):
            assert a != b and linked.setdefault(a, b) == b
    assert len(linked) > 10 and len(set(linked.values())) == len(linked)


def test_a_key_is_required(spark):
    with pytest.raises(TypeError, match="key"):
        pii.pseudonymise(edge.documents(spark))
    for key in (b"", b"k" * 33):
        with pytest.raises(ValueError, match="32 bytes"):
            pii.pseudonymise(edge.documents(spark), key=key)
    for value in VALUES.values():
        assert pii.pseudonymised(value, b"k" * 32)[1] == 1


@given(st.integers(1, 400), st.binary(min_size=1, max_size=8))
def test_permutation_is_a_bijection(size, key):
    assert sorted(pii.permuted(x, size, key) for x in range(size)) == list(range(size))


def test_keys_differ():
    assert pii.pseudonymised(VALUES["card"], b"a") != pii.pseudonymised(VALUES["card"], b"b")


def test_rows(spark):
    rows = [(1, f"mail {VALUES['mail']}", None, 1, "h", 1.0), (2, None, None, 1, "h", 1.0), (None, VALUES["ip"], None, 1, "h", 1.0), *edge.ROWS]
    out = pii.pseudonymise(edge.documents(spark, rows), key=KEY).collect()
    assert sorted(((r.doc_id, r.text, r.n_values) for r in out), key=str) == sorted(
        ((r[0], *(pii.pseudonymised(r[1], KEY) if r[1] is not None else (None, 0))) for r in rows), key=str
    )
    assert pii.pseudonymise(edge.empty(spark), key=KEY).collect() == []
