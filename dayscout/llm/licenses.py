"""License scans: normalised text against license templates by the Dice coefficient of
their word bigrams.

Dice 2|A and B| / (|A| + |B|) can reach t only if the smaller set has at least t / (2 - t)
of the larger one's size: these bounds leave few segments and few templates to compare.
Segments are compared where they are read; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Notices by which common licenses are declared. Fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-2-Clause": "This software is released under the BSD 2-Clause License",
    "BSD-3-Clause": "This software is released under the BSD 3-Clause License",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0",
}
THRESHOLD = 0.8


def normalised(text: Column) -> Column:
    """A-Z lower-cased, every run of other than a-z and 0-9 one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def template_bigrams(text: str) -> list[str]:
    """The word bigrams of a template; the second occurrence of one ends in ``#1``, and so
    on, so that a bag of bigrams is a set."""
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    grams = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    before = [grams[:i].count(g) for i, g in enumerate(grams)]
    return [f"{g}#{n}" if n else g for g, n in zip(grams, before, strict=True)]


def _bigrams(words: str) -> Column:
    return F.transform(
        F.slice(words, F.lit(1), F.size(words) - 1),
        lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)),
    )


def _told_apart(grams: str) -> Column:
    def one(g: Column, i: Column) -> Column:
        n = F.size(F.filter(F.slice(grams, F.lit(1), i), lambda x: x == g))
        return F.when(n > 0, F.concat_ws("#", g, n)).otherwise(g)

    return F.transform(grams, one)


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    separator: str | None = "\n",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per segment that declares a license: id, segment (from 0), license, score.

    Segments are the parts of a text between separators (a pattern; None: the text whole).
    The template of the highest score counts, of equal scores the first by name. Null and
    empty texts, and segments of fewer than two words, have no bigrams and declare none;
    a segment whose number of words no template's bounds admit is not compared, however
    long; repeated rows each report; other columns are ignored."""
    sizes = {name: template_bigrams(templates[name]) for name in sorted(templates)}
    if any(not x for x in sizes.values()):
        raise ValueError("a template needs two words")
    ratio = threshold / (2 - threshold)
    text = F.coalesce(F.col(text_column), F.lit(""))
    parts = F.array(text) if separator is None else F.split(text, separator, -1)
    # normalised before they are exploded, so that the filters below read a column and are
    # not pushed into copies of the expression
    rows = docs.select(
        F.col(id_column).alias("_id"), F.posexplode(F.transform(parts, normalised)).alias("segment", "_s")
    )
    size = F.length("_s") - F.length(F.replace("_s", F.lit(" "), F.lit("")))  # bigrams
    least = min(len(x) for x in sizes.values()) * ratio
    most = max(len(x) for x in sizes.values()) / ratio
    rows = rows.where((size >= least) & (size <= most) & (F.col("_s") != ""))
    rows = rows.select("_id", "segment", F.split("_s", " ").alias("_w"))
    rows = rows.select("_id", "segment", _bigrams("_w").alias("_g"))
    rows = rows.select("_id", "segment", _told_apart("_g").alias("_b"))
    scores = []
    for name, grams in sizes.items():
        n = F.size("_b")
        near = (n >= ratio * len(grams)) & (n <= len(grams) / ratio)
        both = F.size(F.array_intersect("_b", F.array(*[F.lit(g) for g in grams])))
        dice = F.when(near, F.lit(2.0) * both / (n + len(grams))).otherwise(0.0)
        scores.append(F.struct(dice.alias("score"), F.lit(name).alias("license")))
    best = F.reduce(
        F.array(*scores),
        F.struct(F.lit(0.0).alias("score"), F.lit("").alias("license")),
        lambda a, x: F.when(x["score"] > a["score"], x).otherwise(a),
    )
    good = F.filter(F.array(best), lambda x: x["score"] >= threshold)
    return rows.select(F.col("_id").alias(id_column), "segment", F.inline(good)).select(
        id_column, "segment", "license", "score"
    )
