"""The context of a match is that of the whole text, whatever else matches there."""

import random
import re

from dayscout.llm import pii

SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
BAD = re.compile("^(?:000|666|9)|-00-|-0000$")
TEXTS = [
    "SSN: 123-45-6789, 234-56-7891",
    "SSN: 123-45-6789, 000-56-7891, 345-67-8912",
    "123-45-6789 and 234-56-7891 (social security)",
    "part 123-45-6789, 234-56-7891",
    "SSN" + " " * 37 + "123-45-6789",
    "SSN" + " " * 38 + "123-45-6789",
    "123-45-6789" + "\U0001f600" * 37 + "ssn",
    "123-45-6789" + "\U0001f600" * 38 + "ssn",
]


def texts():
    rnd = random.Random(3)
    parts = ["ssn", " ", ", ", "123-45-6789", "000-45-6789", "234-56-7891", "é\U0001f600", "x" * 17]
    return TEXTS + ["".join(rnd.choice(parts) for _ in range(rnd.randint(2, 60))) for _ in range(300)]


def brute(text):
    """(start, end) of the numbers with a context word within 40 code points."""
    out = []
    for m in re.finditer(SSN, text):
        near = text[max(0, m.start() - 40) : m.start()] + " " + text[m.end() : m.end() + 40]
        if not BAD.search(m.group()) and re.search("ssn|social security|social insurance", near.lower()):
            out.append((m.start(), m.end()))
    return out


def test_numbers_after_one_context_word(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = {r.doc_id: [(s.start, s.end) for s in r.pii if s.kind == "ssn"] for r in pii.find_pii(df).collect()}
    assert found == {i: brute(t) for i, t in rows}
    assert [len(found[i]) for i in range(8)] == [2, 2, 2, 0, 1, 0, 1, 0]
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert clean[0] == "SSN: <SSN>, <SSN>" and clean[3] == TEXTS[3]
    assert clean[1] == "SSN: <SSN>, 000-56-7891, <SSN>"
