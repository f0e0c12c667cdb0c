import time

import pytest

from hourgrid.llm import pii

ES, AT, GB = "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "GB82 WEST 1234 5698 7654 32"


@pytest.mark.parametrize("before, iban, after", [
    ("IBAN ", ES, " please"), ("IBAN ", ES, " BIC CAIXESBB"), ("", ES.replace(" ", ""), " EUR 500"), ("", AT, " 2024-01-01"),
    ("", ES, " CAIXa"), ("", ES.replace(" ", ""), " 20240101123456789012"), ("", GB, " BIC NWBKGB2L"), ("REF1 ", ES, " BIC"),
    ("AB12 CDEF GHIJ ", ES, " X"), ("", "SE45 5000 0000 0583 9825 7466", " SEB"), ("", "BE68 5390 0754 7034", " BBRU BEBB 100"),
    ("", "NO93 8601 1117 947", " DNB"), ("", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", " BIC"),
])
def test_iban_before_other_tokens(before, iban, after):
    text = f"{before}{iban}{after}"
    assert [(k, text[a:b]) for k, a, b, _ in pii.Finder().spans(text) if k == "iban"] == [("iban", iban)]
    assert pii.redacted(text, pii.Finder().spans(text)) == f"{before}<IBAN>{after}"


def test_ibans_in_a_row():
    text = f"{ES} {AT} {GB}"
    assert [text[a:b] for k, a, b, _ in pii.Finder().spans(text) if k == "iban"] == [ES, AT, GB]
    assert not [s for s in pii.Finder().spans(f"{ES[:-1]}3 BIC CAIXESBB") if s[0] == "iban"]


def test_country_without_a_known_length():
    body = "1234567890123456"
    check = 98 - int("".join(str(int(c, 36)) for c in body + "ZZ00")) % 97
    code = f"ZZ{check:02d}{body}"
    assert [k[:3] for k in pii.Finder().spans(f"{code} BIC ABCD")] == [("iban", 0, len(code))]


def test_time_is_linear_in_proposals():
    finder, start = pii.Finder(), time.time()
    finder.spans("AB12 " * 40000 + "ES91 2100 " * 20000)
    assert time.time() - start < 15
