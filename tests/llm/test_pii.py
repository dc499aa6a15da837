import hashlib
import re

import pytest

from dayscout.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None,
    "",
    "a@b.c_x@e.f a@b.c.d@e @ x@y ü.ß@x.org",
    "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.004 256.1.1.1 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 4111  1111 5500005555555559",
    "+1 (042) 555-7845x +49 30 1234567 +1 2 + 3 +1....9 +12345678901234567",
    "é\U0001f600 me@x.org " * 300,
    "9" * 30_000,
    "1.2.3." * 3_000,
    "card 4012888888881881, ip 10.0.0.1, call +44 20 7946 0958, mail q@w.ee",
    "+4111111111111111@x.com",
]


def valid(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]


def joined(found):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_chars long")


def test_base_spans(spark, docs, odd, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "n_chars")
    for df in (docs, odd.select("doc_id", "text", "n_chars"), table):
        got = {(r.doc_id, r.base_sha256): r for r in pii.report(df).collect()}
        for row in df.collect():
            want = spans(row.text)
            r = got[row.doc_id, hashlib.sha256(joined(want).encode()).hexdigest()]
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, *_ in want) for x in BASE]
            assert r.spans.startswith(joined(want))


def test_checksums_and_context_add_spans(spark):
    rows = [
        (0, "iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432"),
        (1, "DE88 3704 0044 0532 0130 00"),
        (2, "his SSN is 123-45-6789"),
        (3, "part 123-45-6789"),
        (4, "ssn 000-45-6789"),
    ]
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: "iban:5:32,iban:37:59", 1: "", 2: "ssn:11:22", 3: "", 4: ""}


def test_context_raises_scores(docs):
    rows = pii.find_pii(docs.where("doc_id in (3, 9)")).collect()
    score = {(r.doc_id, s.kind): s.score for r in rows for s in r.pii}
    assert score[9, "card"] > 0.6 and score[9, "email"] > 0.7 and score[3, "ip"] == 0.6


def test_redacted(docs, odd, none):
    out = pii.redact(docs).collect()
    assert out[0].text is None and out[0].n_chars is None
    for r in out[1:]:
        assert not spans(r.text) and r.n_chars == len(r.text)
    assert out[9].text == "card <CARD>, ip <IP>, call <PHONE>, mail <EMAIL>"
    clean = odd.where("doc_id in (6, 9, 10, 11)")
    assert sorted(map(str, pii.redact(clean).collect())) == sorted(map(str, clean.collect()))
    assert pii.redact(none).columns == none.columns and pii.redact(none).count() == pii.report(none).count() == 0
