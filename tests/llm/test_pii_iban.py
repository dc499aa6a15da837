"""Account numbers end where their country's numbers end, whatever follows."""

import re
from collections import Counter

import pytest

from dayscout.llm import pii

NUMBERS = [
    "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO9386011117947",
    "FR14 2004 1010 0505 0001 3M02 606", "MT84MALT011000012345MTLCAST001S", "BE68539007547034",
]
AFTER = ["", " BIC COBADEFFXXX", " 2024", " EUR 12", ", EUR", " GB82WEST12345698765432", " A"]


def test_lengths():
    lands = [c for x in pii.IBAN_LENGTHS.values() for c in x.split("|")]
    assert max(Counter(lands).values()) == 1 and all(re.fullmatch("[A-Z]{2}", c) for c in lands)


def test_what_follows_a_number(spark):
    texts = [f"IBAN {n}{a}" for n in NUMBERS for a in AFTER]
    texts += ["DE88370400440532013000 BIC COBADEFFXXX", "DE89370400440532013000EUR", "xDE89370400440532013000"]
    texts.append("RE12 NO12 DE89 3704 0044 0532 0130 00")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = [k for k in pii.KINDS if k.name == "iban"]
    found = {r.doc_id: [r.text[s.start : s.end] for s in r.pii] for r in pii.find_pii(df, kinds=kinds).collect()}
    want = [[n] + ["GB82WEST12345698765432"] * ("GB82" in a) for n in NUMBERS for a in AFTER]
    assert [found[i] for i in range(len(texts))] == [*want, [], [], [], ["DE89 3704 0044 0532 0130 00"]]
    clean = {r.doc_id: r.text for r in pii.redact(df, kinds=kinds).collect()}
    assert clean[1] == "IBAN <IBAN> BIC COBADEFFXXX" and clean[2] == "IBAN <IBAN> 2024"


@pytest.mark.parametrize("text", ["DE89 " * 20_000, "A1" * 30_000, "DE893704004405320130" * 3_000])
def test_long_runs(spark, text):
    df = spark.createDataFrame([(0, text)], "doc_id long, text string")
    kinds = [k for k in pii.KINDS if k.name == "iban"]
    assert pii.find_pii(df, kinds=kinds).first().pii == []
