"""An IBAN keeps its own end when a capital word or code follows it."""

import pytest

from salesmart.llm import pii

CODES = ("ES91 2100 0418 4502 0005 1332", "PL61 1090 1014 0000 0712 1981 2874", "AT61 1904 3002 3457 3201",
         "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947")


@pytest.mark.parametrize("code", [*CODES, *(c.replace(" ", "") for c in CODES)])
@pytest.mark.parametrize("after", ["", " BIC", " BIC CODE", " A", " CASH 1234 X", ".", " and BIC"])
def test_iban_before_a_capital_word(code, after):
    spans = [s[:3] for s in pii.find_spans(f"IBAN: {code}{after}") if s[0] == "iban"]
    assert spans == [("iban", 6, 6 + len(code))]


def test_two_ibans_in_a_row():
    text = " ".join(CODES[:3])
    assert [text[s:e] for k, s, e, *_ in pii.find_spans(text) if k == "iban"] == list(CODES[:3])


def test_a_wrong_checksum_stays_out():
    assert not [s for s in pii.find_spans("IBAN ES91 2100 0418 4502 0005 1333 BIC") if s[0] == "iban"]


@pytest.mark.parametrize("before", ["REF AB12 3456 ", "DE00 1234 ", "GB82 "])
def test_a_false_start_does_not_hide_the_iban_behind_it(before):
    text = f"{before}GB82 WEST 1234 5698 7654 32."
    assert [text[s:e] for k, s, e, *_ in pii.find_spans(text) if k == "iban"] == ["GB82 WEST 1234 5698 7654 32"]


@pytest.mark.parametrize("code", ["GB82-WEST-1234-5698-7654-32", "gb82 west 1234 5698 7654 32", "de89370400440532013000"])
def test_hyphens_and_lower_case(code):
    assert [s[:3] for s in pii.find_spans(f"to {code} now") if s[0] == "iban"] == [("iban", 3, 3 + len(code))]


@pytest.mark.parametrize("text", ["GB82 WEST 1234 5698 7654 3", "GB82  WEST 1234 5698 7654 32", "ZZ82 WEST 1234 5698 7654 32",
                                  "GB82 WEST 1234 5698 7654 321", "xGB82WEST12345698765432", "GB82"])
def test_a_wrong_length_country_or_shape_stays_out(text):
    assert not [s for s in pii.find_spans(text) if s[0] == "iban"]


@pytest.mark.parametrize("number,found", [("123-45-6789", 1), ("000-45-6789", 0), ("666-45-6789", 0), ("912-45-6789", 0),
                                          ("123-00-6789", 0), ("123-45-0000", 0)])
def test_ranges_of_national_ids(number, found):
    assert sum(s[0] == "national_id" for s in pii.find_spans(f"his ssn is {number}")) == found
