"""Quality scores from positive and unlabelled text.

Trusted positives are documents labelled 1; every document of the corpus is unlabelled
text, a mixture of class prior pi of good and 1 - pi of bad. A linear model g minimises
the non-negative unbiased risk (Kiryo et al. 2017) with the logistic loss l:

    pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)])

The class prior is estimated as in best bin estimation (Garg et al. 2021): the share of
unlabelled text above a score, over the share of positives above it, is at least pi, and
is pi where no bad text scores so high. Labels 0 are not used at all.

Features are counted once per document. Each step of the fit is one pass over the feature
table that returns sums, as many as there are pairs of features, however many rows.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayscout.llm.shared import stored

#: bytes whose shares are features, each group as one
_GROUPS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b" ",
    b"\n",
    b".",
    b",",
    b";:",
    b"!",
    b"?",
    b"|",
    b"*",
    b"%",
    b"#",
    b"$",
    b"&",
    b"@",
    b"=+<>~^",
    b"_/\\",
    b"()[]{}",
    b"'\"`",
    b"-",
)
_OF_BYTE = np.zeros((256, len(_GROUPS)))
for _i, _g in enumerate(_GROUPS):
    _OF_BYTE[list(_g), _i] = 1
WIDTH = len(_GROUPS) + 15
#: bins of the score in which the class prior is estimated
BINS = 200


def features(text: str | None) -> list[float]:
    """Of the whole text: shares of bytes, repetition of words and lines, lengths. An empty
    text has shares of zero."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(len(raw), 1)
    shares = counts @ _OF_BYTE / n
    words = (text or "").split()
    m = max(len(words), 1)
    times = Counter(words)
    most = max(times.values(), default=0)
    once = sum(map((1).__eq__, times.values()))
    again = sum(map(operator.eq, words, words[1:])) / m
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in (text or "").split("\n") if x]
    distinct = len(set(lines)) / max(len(lines), 1)
    longest = max(map(len, words), default=0)
    upper = sum(map(str.isupper, words)) / m
    return [
        *np.sqrt(shares).tolist(),
        np.sqrt(again),
        np.sqrt(upper),
        len(times) / m,
        once / m,
        np.log1p(len(times)) / np.log1p(m),
        np.log1p(pairs) / np.log1p(m),
        np.sqrt(most / m),
        distinct,
        np.log1p(len(words)),
        np.log1p(len(raw) / m),
        np.log1p(m / max(len(lines), 1)),
        np.log1p(longest),
        np.log1p(len(lines)),
        float(len(words) < 5),
        float(counts[128:].sum()) / n,
    ]


def _feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = b.drop(columns=["_text"])
        out["x"] = pd.Series([features(t) for t in b["_text"]], b.index, object)
        yield out


def _sums(weights: np.ndarray, mean: np.ndarray, scale: np.ndarray):
    """Sums of one partition: rows, losses, gradient and Hessian of the unlabelled part,
    then of the positives."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            if not len(b):
                continue
            x = np.column_stack((np.ones(len(b)), (np.stack(b["x"].to_list()) - mean) / scale))
            g = x @ weights
            s = 1 / (1 + np.exp(-np.clip(g, -500, 500)))
            softplus = np.logaddexp(0, g)
            p = b["positive"].to_numpy(bool)
            parts = [
                [len(b), softplus.sum()], x.T @ s, ((x * (s * (1 - s))[:, None]).T @ x).ravel(),
                [p.sum(), softplus[p].sum(), (softplus - g)[p].sum()], x[p].sum(0), x[p].T @ s[p],
            ]
            part = np.concatenate(parts)
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"k": np.arange(len(total)), "v": total})

    return run


def _summed(rows: DataFrame, run, n: int) -> np.ndarray:
    out = np.zeros(n)
    for r in rows.mapInPandas(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r["k"]] = r["v"]
    return out


class Risk:
    """The non-negative risk, its gradient and a Hessian of its unlabelled part."""

    def __init__(self, rows: DataFrame, mean: np.ndarray, scale: np.ndarray, penalty: float):
        self.rows, self.mean, self.scale, self.penalty = rows, mean, scale, penalty

    def at(self, w: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
        d = len(w)
        s = _summed(self.rows, _sums(w, self.mean, self.scale), 2 * 1 + d + d * d + 3 + 2 * d)
        n, u_loss = s[:2]
        u_grad, hessian = s[2 : 2 + d] / n, s[2 + d : 2 + d + d * d].reshape(d, d) / n
        m, p_minus, p_plus = s[2 + d + d * d :][:3]
        p_x, p_sx = s[5 + d + d * d :][:d] / m, s[5 + 2 * d + d * d :] / m
        ridge = np.full(d, self.penalty)
        ridge[0] = 0
        negative = u_loss / n - prior * p_minus / m
        value = prior * p_plus / m + max(0.0, negative) + (ridge * w * w).sum() / 2
        gradient = prior * (p_sx - p_x) + ridge * w
        if negative > 0:
            gradient = gradient + u_grad - prior * p_sx
        return value, gradient, hessian + np.diag(ridge + 1e-9)

    def least(self, w: np.ndarray, prior: float, steps: int) -> np.ndarray:
        """Damped Newton steps, each halved until the risk falls."""
        value, gradient, hessian = self.at(w, prior)
        for _ in range(steps):
            step = np.linalg.solve(hessian, gradient)
            size = 1.0
            while size > 1e-3:
                new = self.at(w - size * step, prior)
                if new[0] < value:
                    break
                size /= 2
            else:
                return w
            w = w - size * step
            done = value - new[0] < 1e-5
            value, gradient, hessian = new
            if done:
                return w
        return w


def best_bin(unlabelled: np.ndarray, positive: np.ndarray) -> float:
    """The class prior from counts per bin of the score, in ascending order: the least ratio
    of the shares above a bin, each with a Hoeffding margin for its number of rows."""
    n, m = unlabelled.sum(), positive.sum()
    u = np.cumsum(unlabelled[::-1]) / n
    p = np.cumsum(positive[::-1]) / m
    margin = np.sqrt(np.log(40) / (2 * n)) + np.sqrt(np.log(40) / (2 * m))
    fit = p > 0
    bound = (u[fit] + margin) / p[fit]
    best = int(np.argmin(bound))
    return float(np.clip(u[fit][best] / p[fit][best], 0.01, 0.99))


def _histogram(rows: DataFrame, w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> float:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros(2 * BINS)
        for b in batches:
            s = scores(np.stack(b["x"].to_list()), w, mean, scale) if len(b) else np.empty(0)
            k = np.minimum((s * BINS).astype(int), BINS - 1)
            out[:BINS] += np.bincount(k, minlength=BINS)
            out[BINS:] += np.bincount(k[b["positive"].to_numpy(bool)], minlength=BINS)
        yield pd.DataFrame({"k": np.arange(2 * BINS), "v": out})

    counts = _summed(rows, run, 2 * BINS)
    return best_bin(counts[:BINS], counts[BINS:])


def scores(x: np.ndarray, w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    g = w[0] + ((x - mean) / scale) @ w[1:]
    return 1 / (1 + np.exp(-np.clip(g, -500, 500)))


def fit(rows: DataFrame, penalty: float = 1e-3, steps: int = 12):
    """(weights, mean, scale, prior) from rows (x, positive); None without positives."""
    moments = rows.select(F.posexplode("x").alias("k", "v"), "positive").groupBy("k").agg(
        F.avg("v").alias("m"), F.stddev_pop("v").alias("s"), F.sum(F.col("positive").cast("long")).alias("p")
    )
    found = {r["k"]: r for r in moments.collect()}
    if not found or not found[0]["p"]:
        return None
    mean = np.array([found[k]["m"] for k in range(WIDTH)])
    scale = np.array([found[k]["s"] for k in range(WIDTH)])
    scale[scale < 1e-6] = 1.0
    # half of the positives against all text orders the scores; the other half, which that
    # fit has not seen, gives the prior
    side = F.pmod(F.xxhash64("x"), F.lit(2))
    seen, unseen = (rows.select("x", (F.col("positive") & (side == k)).alias("positive")) for k in (0, 1))
    if seen.where("positive").isEmpty() or unseen.where("positive").isEmpty():
        seen = unseen = rows
    w = Risk(seen, mean, scale, penalty).least(np.zeros(WIDTH + 1), 0.5, steps)
    prior = _histogram(unseen, w, mean, scale)
    return Risk(rows, mean, scale, penalty).least(w, prior, steps), mean, scale, prior


def _feature_table(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, remainder: int) -> DataFrame:
    """(_id, held_out, x, positive) of every row, stored."""
    held_out = F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == remainder
    trusted = (
        labels.select(F.col("doc_id").alias("_i"), "quality")
        .where("_i is not null and quality is not null")
        .groupBy("_i")
        .agg(F.min("quality").alias("least"))
        .where("least = 1")
        .select("_i")
    )
    kind = docs.schema[id_column].dataType.simpleString()
    counted = docs.select(
        F.col(id_column).alias("_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text_column).alias("_text"),
    ).mapInPandas(_feature_rows, f"_id {kind}, held_out boolean, x array<double>")
    return stored(
        counted.join(trusted, F.col("_id") == F.col("_i"), "left").select(
            "_id", "held_out", "x", (F.col("_i").isNotNull() & ~F.col("held_out")).alias("positive")
        ),
        "features",
    )


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    id_column: str = "doc_id",
    text_column: str = "text",
    held_out_remainder: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score (0 to 1, higher: likelier good),
    predicted (1 from ``threshold`` on).

    ``labels`` (doc_id, quality): positives are ids with quality 1 whose crc32 modulo 5
    is not ``held_out_remainder``; an id labelled both ways is not trusted. Null texts
    count as empty and are scored like any other; rows that repeat an id are scored one by
    one; a null id is never labelled and counts as not held out; other columns are ignored.
    Without any positive every score is 0.5; an empty table gives an empty result."""
    rows = _feature_table(docs, labels, id_column, text_column, held_out_remainder)
    model = fit(rows.select("x", "positive"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if model is None or not len(b):
                s = np.full(len(b), 0.5)
            else:
                s = scores(np.stack(b["x"].to_list()), *model[:3])
            yield b.drop(columns=["x"]).assign(score=s, predicted=(s >= threshold).astype(np.int32))

    kind = docs.schema[id_column].dataType.simpleString()
    return rows.drop("positive").mapInPandas(
        score, f"_id {kind}, held_out boolean, score double, predicted int"
    ).withColumnRenamed("_id", id_column)


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    id_column: str = "doc_id",
    text_column: str = "text",
    held_out_remainder: int = 0,
) -> DataFrame:
    """The rows that ``score_quality`` would predict as 1, with all columns. Texts stay where
    they are: they are scored as they are filtered, and only the features were stored."""
    rows = _feature_table(docs, labels, id_column, text_column, held_out_remainder)
    model = fit(rows.select("x", "positive"))
    if model is None:
        return docs if threshold <= 0.5 else docs.limit(0)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            x = np.array([features(v) for v in t]).reshape(-1, WIDTH)
            yield pd.Series(scores(x, *model[:3]))

    return docs.where(score(F.col(f"`{text_column}`")) >= threshold)
