"""Pseudonyms: permutations, validity, links, untouched text."""

import datetime as dt
import re

import pytest
from tierwise.llm import pii

P = pii.Pseudonyms(b"k")


@pytest.mark.parametrize("sizes", [(1, 1), (7, 3), (10, 100), (16, 16)])
def test_pair_is_a_permutation(sizes):
    f = pii.Feistel(b"k", "x")
    got = {f.pair(a, b, sizes) for a in range(sizes[0]) for b in range(sizes[1])}
    assert got == {(a, b) for a in range(sizes[0]) for b in range(sizes[1])}


def test_number_and_digits_are_permutations_that_depend_on_key_and_kind():
    f, g, h = pii.Feistel(b"k", "x"), pii.Feistel(b"l", "x"), pii.Feistel(b"k", "y")
    a = [f.number(i, 500) for i in range(500)]
    assert sorted(a) == list(range(500))
    assert len({tuple(f.digits([i // 26, i % 26], [10, 26])) for i in range(260)}) == 260
    assert a != [g.number(i, 500) for i in range(500)] and a != [h.number(i, 500) for i in range(500)]


def one(text):
    new, found = P.replace(text)
    return new, {k: n for k, n in found.items() if n}


def test_formats_stay_and_check_digits_hold():
    new, found = one("card 4111 1111 1111 1111, again 4111111111111111!!")
    assert found == {"card": 2}
    a, b = re.search(r"card (\d{4} \d{4} \d{4} \d{4}), again (\d{16})!!", new).groups()
    assert a.replace(" ", "") == b != "4111111111111111" and pii.luhn_digit(b[:-1]) == b[-1]
    new, found = one("GB82 WEST 1234 5698 7654 32 and DE89370400440532013000")
    assert found == {"iban": 2} and pii._iban_mod(new.split(" and ")[1]) == 1
    assert pii._iban_mod(new.split(" and ")[0].replace(" ", "")) == 1 and "WEST" not in new
    new, found = one("from 2024-02-29 to 31.12.1999")
    assert found == {"date": 2}
    a, b = re.fullmatch(r"from (\S+) to (\S+)", new).groups()
    dt.date.fromisoformat(a), dt.datetime.strptime(b, "%d.%m.%Y")
    new, found = one("call +1 (013) 555-0024 or 013-555-0024")
    assert found == {"phone": 2} and new.startswith("call +1 (")
    assert re.sub(r"\D", "", new.split(" or ")[0])[1:] == re.sub(r"\D", "", new.split(" or ")[1])
    new, found = one("The.22@mail9.example.com, at 10.0.255.1.")
    assert found == {"email": 1, "ip": 1} and re.fullmatch(r"[A-Z][a-z]{2}\.\d\d@mail9\.example\.com, at [\d.]+\.", new)
    new, found = one('token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" x')
    assert found == {"secret": 1} and re.fullmatch(r'token = "[0-9a-f]{40}" x', new) and "2abc3ff2" not in new
    assert one("éà.9@mail1.example.com")[1] == {"email": 1}


@pytest.mark.parametrize("text", [
    "", "no digits here", "number 4111111111111112 fails", "version 2.0.", "256.1.1.1", "2023-02-29", "00.13.2020",
    "a4111111111111111", "41111111111111110000000000", "GB82 WEST 1234 5698 7654 33", "000-12-3456", "1.2.3.4.5", "x@y"])
def test_what_is_not_valid_stays(text):
    assert one(text) == (text, {})


def test_equal_values_stay_linked_and_the_rest_untouched(spark):
    ip = "83.229.25.121"
    rows = [(1, f"seen {ip} here"), (2, f"{ip}"), (2, f"{ip}"), (3, None), (4, ""), (None, "plain"), (5, ("word " * 50000) + ip),
            (6, "83.229.25.122")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as n_ip", "8 as key")
    got = {(r["doc_id"], r["text"], r["n_ip"], r["n_found"], r["key"]) for r in pii.pseudonymise(docs, b"k").collect()}
    new, other = P.replace(ip)[0], P.replace("83.229.25.122")[0]
    assert new != other
    assert got == {(1, f"seen {new} here", 1, 1, 8), (2, new, 1, 1, 8), (3, None, 0, 0, 8), (4, "", 0, 0, 8),
                   (None, "plain", 0, 0, 8), (5, "word " * 50000 + new, 1, 1, 8), (6, other, 1, 1, 8)}
    assert pii.pseudonymise(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text,pattern,form", [
    ("at 2024-01-02T10:00:00Z.", r"at (\d{4}-\d\d-\d\d)T10:00:00Z\.", "%Y-%m-%d"),
    ("on 2024-01-02Z", r"on (\d{4}-\d\d-\d\d)Z", "%Y-%m-%d"),
    ("born 12/25/2020", r"born (\d\d/\d\d/\d{4})", "%m/%d/%Y"),
    ("born 1/5/1990, x", r"born (\d{1,2}/\d{1,2}/\d{4}), x", "%d/%m/%Y"),
    ("born 1/25/1990, x", r"born (\d{1,2}/\d{1,2}/\d{4}), x", "%m/%d/%Y"),
    ("(2024/01/02)", r"\((\d{4}/\d\d/\d\d)\)", "%Y/%m/%d"),
    ("5 March 1990.", r"(\d{1,2} [A-Z][a-z]+ \d{4})\.", "%d %B %Y"),
    ("05 MAR 1990", r"(\d\d [A-Z]{3} \d{4})", "%d %b %Y"),
    ("on March 5, 1990", r"on ([A-Z][a-z]+ \d{1,2}, \d{4})", "%B %d, %Y"),
    ("on sept 5 1990", r"on ([a-z]{3} \d{1,2} \d{4})", "%b %d %Y")])
def test_date_forms(text, pattern, form):
    new, found = one(text)
    assert found == {"date": 1} and new != text
    dt.datetime.strptime(re.fullmatch(pattern, new)[1], form)


def test_dates_of_a_form_stay_different():
    days = [dt.date(1990, 1, 1) + dt.timedelta(i) for i in range(366)]
    for write in (lambda d: f"{d:%Y-%m-%d}", lambda d: f"{d.day}/{d.month}/{d.year}", lambda d: f"{d:%m/%d/%Y}",
                  lambda d: f"{d.day} {d:%B %Y}"):
        assert len({P.replace(write(d))[0] for d in days}) == len({write(d) for d in days})
    both = [f"{d:%m/%d/%Y}" for d in days if d.day > 12] + [f"{d:%d/%m/%Y}" for d in days]
    assert len({P.replace(t)[0] for t in both}) == len(both)
    assert one("1st of March 1990")[0][-4:].isdigit() and one("21st March 1990")[1] == {"date": 1}


@pytest.mark.parametrize("text", ["31.12/1999", "5 marching 1990", "31 June 1990", "13/13/2020", "May 2020", "1/2/3/1990"])
def test_no_dates(text):
    assert one(text) == (text, {})


@pytest.mark.parametrize("iban", ["ES91 2100 0418 4502 0005 1332", "PL61109010140000071219812874", "DE89 3704 0044 0532 0130 00",
                                  "GB82WEST12345698765432"])
@pytest.mark.parametrize("tail", [" CALL", " THE", " CALL ME NOW", " 2024-01-02"])
def test_iban_before_an_upper_case_word(iban, tail):
    new, found = one(f"pay {iban}{tail}")
    assert found["iban"] == 1 and found.get("date", 0) == ("2024" in tail)
    assert new.startswith("pay " + iban[:2]) and iban not in new and ("2024" in tail or new.endswith(tail))
    assert pii._iban_mod(new[4:4 + len(iban)].replace(" ", "")) == 1
    assert new[4:4 + len(iban)] == P.replace(iban)[0]
