import re

import pytest

from dayscout.llm import licenses

T = licenses.TEMPLATES


def bag(text):
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def dice(a, b):
    left, both = list(b), 0
    for g in a:
        if g in left:
            left.remove(g)
            both += 1
    return 2.0 * both / (len(a) + len(b)) if a or b else 0.0


def brute(texts, templates, threshold):
    out = []
    for i, t in texts:
        for n, line in enumerate((t or "").split("\n")):
            scored = [(-dice(bag(line), bag(x)), name) for name, x in templates.items()]
            score, name = min(scored)
            if -score >= threshold:
                out.append((i, n, name, -score))
    return out


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_against_all_templates(spark, odd_texts, threshold):
    texts = [t for t in odd_texts if t[0]] + [
        (20, T["MIT"] + "."),
        (21, "x\n" + T["GPL-3.0"].upper() + "!\nthe the the"),
        (22, "Released under the the MIT License Released under the MIT License"),
        (23, "Licensed under CC BY 4.0 or CC BY-SA 4.0"),
        (24, "  Licensed, under: the Apache License - Version 2"),
        (25, "MIT"),
    ]
    templates = T | {"Echo": "go go go go go stop"}
    texts.append((26, "go go go stop go go"))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = [tuple(r) for r in licenses.scan(df, templates, threshold).collect()]
    key = lambda x: (x[0], x[1])
    want = sorted(brute(texts, templates, threshold), key=key)
    assert [x[:3] for x in sorted(got, key=key)] == [x[:3] for x in want]
    assert [x[3] for x in sorted(got, key=key)] == pytest.approx([x[3] for x in want])


def test_whole_texts_and_edges(odd, none):
    assert licenses.scan(odd, separator=None).count() == 0
    assert licenses.scan(none).count() == 0
    with pytest.raises(ValueError, match="two words"):
        licenses.scan(odd, {"X": "one"})
