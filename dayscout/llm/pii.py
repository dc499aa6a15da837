"""Personal data: patterns propose, checksums confirm, context adjusts the score.

Everything is a Column. A pattern's matches come from ``regexp_extract_all`` and the text
between them from ``split`` with the same pattern; running sums of their lengths are the
places of the matches in code points.

Patterns use possessive loops and ``\\G`` so that no text, however long its runs of letters
or digits, makes the matcher recurse or start over in a run it has already failed: they
match exactly what their plain forms match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""

    def step(acc: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return acc + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether letters and digits pass the check of ISO 13616 (remainder 1)."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, acc * 10 + c - 48).otherwise(acc * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(code)), F.lit(0), step) == 1


#: Lengths of account numbers by country: the registry of ISO 13616, and those in use
#: beside it. Fixed values.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK",
    21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL",
    24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "AO|CV|GW|LY|MZ|PT|ST", 26: "DZ|IR|IS|TR",
    27: "BI|CF|CG|CM|DJ|FR|GA|GF|GP|GQ|GR|IT|KM|MC|MF|MG|MQ|MR|NC|PF|PM|RE|SM|TD|TF|WF|YT",
    28: "AL|AZ|BF|BJ|BY|CI|CY|DO|GT|HN|HU|LB|MA|ML|NE|NI|PL|SN|SV|TG", 29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(
    rf"(?:{lands})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}+" for n, lands in IBAN_LENGTHS.items()
)


@dataclass(frozen=True)
class Kind:
    """A pattern, a literal that every match holds (or a pattern for one), what confirms a
    match, the score of a confirmed one, and the words that raise it by ``bonus``."""

    name: str
    pattern: str
    hint: str
    confirm: Callable[[Column], Column]
    score: float
    words: str
    bonus: float = 0.3


_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
        "@",
        lambda m: F.lit(True),
        0.7,
        "mail|contact|write|kontakt|correo|courriel",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "[0-9]\\.[0-9]",
        lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        0.6,
        "address|host|server|client|login|adresse",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        "[0-9]",
        lambda m: F.length(_digits(m)).between(16, 19) & luhn(_digits(m)),
        0.6,
        "card|visa|credit|debit|payment|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        lambda m: F.length(_digits(m)).between(8, 15),
        0.6,
        "phone|call|tel|mobile|fax|handy",
    ),
    # beyond the base: bank accounts, confirmed by their checksum, and national numbers
    # that nothing but the words around them can confirm
    Kind(
        "iban",
        rf"(?:\G|(?<![A-Za-z0-9]))(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}",
        lambda m: mod97(F.regexp_replace(m, " ", "")),
        0.7,
        "iban|account|bank|konto|compte|cuenta",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "[0-9]-[0-9]{2}-[0-9]",
        lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"),
        0.3,
        "ssn|social security|social insurance",
    ),
)
BASE = KINDS[:4]
#: a span is reported from this score on; the base kinds always reach it
THRESHOLD = 0.5
#: code points before and after a match that count as its context
CONTEXT = 40
_BLOCK = 256
_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _holds(text: Column, kind: Kind) -> Column:
    return F.contains(text, F.lit(kind.hint)) if len(kind.hint) == 1 else text.rlike(kind.hint)


def _matches(df: DataFrame, text: str, kind: Kind) -> DataFrame:
    """Adds _m (the matches of the kind), _g (what lies before, between and after) and _s
    (where each match starts)."""
    pattern = F.lit(kind.pattern)
    empty = F.array().cast("array<string>")
    found = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    df = df.withColumn("_m", F.when(_holds(F.col(text), kind), found).otherwise(empty))
    gaps = F.split(F.col(text), kind.pattern, -1)
    df = df.withColumn("_g", F.when(F.size("_m") > 0, gaps).otherwise(empty))
    df = df.withColumn(
        "_l", F.transform("_m", lambda m, i: F.length(m) + F.length(F.get("_g", i)))
    )
    count = F.ceil(F.size("_m") / _BLOCK).cast("int")
    df = df.withColumn(
        "_b",
        F.when(F.size("_m") <= _BLOCK, F.array(F.lit(0))).otherwise(
            F.transform(
                F.sequence(F.lit(0), count - 1),
                lambda b: F.aggregate(
                    F.slice("_l", b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda acc, x: acc + x
                ),
            )
        ),
    )
    return df.withColumn("_s", _starts())


def _scored(kind: Kind) -> Column:
    """For each match: the score if it is confirmed, else null. The context is that of the
    whole text, other matches included."""

    def reported(score: float) -> Column:
        return F.lit(score if score >= THRESHOLD else None).cast("double")

    def one(x: Column) -> Column:
        start, match = x["_s"], x["_m"]
        before = F.substring("_t", F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT)))
        after = F.substring("_t", start + F.length(match) + 1, F.lit(CONTEXT))
        near = F.lower(F.concat(before, F.lit(" "), after)).rlike(rf"(?:{kind.words})")
        score = F.when(near, reported(kind.score + kind.bonus)).otherwise(reported(kind.score))
        return F.when(kind.confirm(match), score)

    return F.transform(F.arrays_zip("_m", "_s"), one)


def _starts() -> Column:
    """Where each match starts: the sum of what lies before it. Sums are taken over blocks
    of matches and within a block, so that a text of very many matches stays cheap."""

    def total(values: Column, first: Column, count: Column) -> Column:
        part = F.slice(values, first, count)
        return F.aggregate(part, F.lit(0), lambda acc, x: acc + x)

    lengths, blocks = F.col("_l"), F.col("_b")
    return F.transform(
        "_m",
        lambda m, i: total(blocks, F.lit(1), F.floor(i / _BLOCK).cast("int"))
        + total(lengths, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)
        + F.length(F.get("_g", i)),
    )


def _spans(name: str) -> Column:
    # zipped, for Spark may copy a column that a lambda names once into it, for each match
    def one(x: Column) -> Column:
        return F.struct(
            F.lit(name).alias("kind"),
            x["_s"].alias("start"),
            (x["_s"] + F.length(x["_m"])).alias("end"),
            x["_c"].alias("score"),
        )

    return F.filter(F.transform(F.arrays_zip("_s", "_m", "_c"), one), lambda x: x["score"].isNotNull())


def find_pii(docs: DataFrame, text_column: str = "text", out: str = "pii", kinds=KINDS) -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end, score), by kind in the order of
    ``kinds``, then start; code points, end exclusive.

    Null and empty texts have an empty array; rows are judged one by one, so repeated rows
    agree; a column named as ``out`` is replaced."""
    keep = [c for c in docs.columns if c != out]
    df = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("_t"),
    )
    done = []
    for n, kind in enumerate(kinds):
        df = _matches(df, "_t", kind)
        df = df.withColumn("_c", _scored(kind))
        df = df.withColumn(f"_found{n}", F.when(F.size("_m") > 0, _spans(kind.name)).otherwise(F.array().cast(_SPAN)))
        done.append(f"_found{n}")
        df = df.select("_row", "_t", *done)
    return df.select("_row.*", F.concat(*[F.col(c) for c in done]).alias(out))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone, base_sha256 (of the spans
    of the four base kinds), spans (all, with those that the checksums and the context
    add). Edge cases as in ``find_pii``."""
    found = find_pii(docs.select(id_column, text_column), text_column, "_pii").select(
        id_column, "_pii"
    )
    base = [k.name for k in BASE]
    counts = [
        F.size(F.filter("_pii", _is(name))).cast("long").alias(f"n_{name}") for name in base
    ]
    of_base = F.filter("_pii", lambda x: x["kind"].isin(base))
    return found.select(
        id_column,
        *counts,
        F.sha2(joined(of_base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("_pii")).alias("spans"),
    )


def _is(name: str):
    return lambda x: x["kind"] == name


def redact(docs: DataFrame, text_column: str = "text", kinds=KINDS) -> DataFrame:
    """``docs`` with every reported span replaced by its kind in angle brackets, one kind
    after the other, and ``n_chars``, where there is one, counted anew. Null stays null.

    A kind is searched in what the kinds before it left, so of overlapping spans the
    earlier kind's wins and nothing personal is left over."""
    df = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("_t"),
    )
    for kind in kinds:
        df = _matches(df, "_t", kind).withColumn("_c", _scored(kind))
        pieces = F.transform(F.arrays_zip("_g", "_m", "_c"), _piece(f"<{kind.name.upper()}>"))
        left = F.when(F.size("_m") > 0, F.array_join(pieces, "")).otherwise(F.col("_t"))
        df = df.select("_row", left.alias("_t"))
    new = {text_column: F.when(F.col(f"_row.`{text_column}`").isNotNull(), F.col("_t"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(new[text_column]).cast(docs.schema["n_chars"].dataType)
    return df.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def _piece(mark: str):
    def one(x: Column) -> Column:
        match = F.when(x["_c"].isNotNull(), F.lit(mark)).otherwise(F.coalesce(x["_m"], F.lit("")))
        return F.concat(x["_g"], match)

    return one
