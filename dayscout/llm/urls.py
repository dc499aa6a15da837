"""URL filter over a sorted array of 64-bit digests.

The rules are strings ``host + path``. Their xxhash64 keys lie sorted in one file with
the offsets and bytes of the full strings behind them. A url is expanded into the few
strings that could be a rule for it (those of its parent domains that have as many labels
as a rule's host, times the path lengths that occur among the rules); the digests of those are probed in the memory-mapped key
array by vectorised binary search, and every hit is confirmed against the stored string.

A list up to ``max_bytes`` is one file that each executor fetches once; a longer one
(``filter_urls_sharded``) is cut by the leading key bits, and the probes travel to the
shards instead.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayscout.llm.shared import stored, work_folder

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MAGIC = b"DIGESTS2"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/ ? #``, A-Z lower-cased, and then
    up to ``? #``. Both are empty for null and for a url without ``://``."""
    at = F.locate("://", url)
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def keys_of(strings: Sequence[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s) for s in strings), np.uint64, len(strings))


def pack(rules: Sequence[tuple[str, bool]]) -> bytes:
    """The file: counts, sorted keys, offsets, path lengths, numbers of labels of the hosts,
    verdict bits, strings."""
    first: dict[bytes, bool] = {}
    for rule, allow in rules:  # a rule given as both blocks
        b = rule.encode()
        first[b] = first.get(b, True) and bool(allow)
    texts = list(first)
    keys = keys_of(texts)
    order = np.argsort(keys, kind="stable")
    texts = [texts[i] for i in order]
    allow = np.array([first[t] for t in texts], np.uint8)
    ends = np.cumsum([0] + [len(t) for t in texts]).astype(np.uint64)
    lengths = np.array(sorted({len(t) - _cut(t) for t in texts}), np.uint32)
    labels = np.array(sorted({t[: _cut(t)].count(b".") + 1 for t in texts}), np.uint32)
    head = struct.pack("<8sQQQ", _MAGIC, len(texts), len(lengths), len(labels))
    parts = (keys[order].tobytes(), ends.tobytes(), lengths.tobytes(), labels.tobytes(), allow.tobytes())
    return head + b"".join(parts) + b"".join(texts)


def _cut(rule: bytes) -> int:
    """Where the path of a rule starts."""
    at = rule.find(b"/")
    return len(rule) if at < 0 else at


class DigestArray:
    """A packed rule list, mapped from a file or a buffer."""

    def __init__(self, source):
        raw = np.memmap(source, np.uint8, "r") if isinstance(source, str) else np.frombuffer(source, np.uint8)
        magic, n, m, k = struct.unpack("<8sQQQ", raw[:32].tobytes())
        if magic != _MAGIC:
            raise ValueError("not a digest array")
        at = 32
        self.keys = raw[at : at + 8 * n].view(np.uint64)
        at += 8 * n
        self.ends = raw[at : at + 8 * (n + 1)].view(np.uint64)
        at += 8 * (n + 1)
        self.path_lengths = raw[at : at + 4 * m].view(np.uint32)
        at += 4 * m
        self.labels = raw[at : at + 4 * k].view(np.uint32)
        at += 4 * k
        self.allow = raw[at : at + n]
        self.texts = raw[at + n :]

    def find(self, strings: Sequence[bytes]) -> np.ndarray:
        """Place of each string in the array, -1 where it is none of the rules. Equal
        keys lie side by side; all of them are compared with the full string."""
        out = np.full(len(strings), -1, np.int64)
        if not len(self.keys) or not len(strings):
            return out
        keys = keys_of(strings)
        low = np.searchsorted(self.keys, keys, "left")
        high = np.searchsorted(self.keys, keys, "right")
        for i in np.flatnonzero(high > low):
            for j in range(low[i], high[i]):
                if self.texts[int(self.ends[j]) : int(self.ends[j + 1])].tobytes() == strings[i]:
                    out[i] = j
                    break
        return out


def probes_of(host: str, path: str, lengths: Sequence[int], labels: Sequence[int]) -> list[str]:
    """Every string that could be a rule for this host and path. ``lengths`` of paths and
    numbers of ``labels`` of hosts are those of the rules, so a host of any length has no
    more probes than rules have shapes."""
    raw = path.encode()
    heads = [raw[:n].decode(errors="ignore") for n in lengths if n <= len(raw)]
    parts = host.rsplit(".", max(labels, default=0))
    whole = host.count(".") + 1
    domains = [host if n == whole else ".".join(parts[-n:]) for n in labels if n <= whole]
    return [domain + h for domain in domains for h in heads]


def judge(hosts: Sequence[str], paths: Sequence[str], index: DigestArray, default: str):
    """(rule, verdict) for each url: the longest rule that fits, else ``default``."""
    lengths, labels = index.path_lengths.tolist(), index.labels.tolist()
    probes, owner = [], []
    for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
        mine = [x.encode() for x in probes_of(h, p, lengths, labels)]
        probes += mine
        owner += [i] * len(mine)
    distinct = {x: k for k, x in enumerate(dict.fromkeys(probes))}
    places = index.find(list(distinct))
    rule: list[str | None] = [None] * len(hosts)
    verdict = [default] * len(hosts)
    best = [-1] * len(hosts)
    for i, x in zip(owner, probes, strict=True):
        j = places[distinct[x]]
        if j >= 0 and len(x) > best[i]:
            best[i], rule[i] = len(x), x.decode()
            verdict[i] = "allow" if index.allow[j] else "block"
    return rule, verdict


def _hosts_and_paths(pages: DataFrame, id_column: str, url_column: str) -> DataFrame:
    chosen = pages.select(F.col(id_column).alias("_id"), F.col(url_column).alias("_u"))
    host, path = split_url(F.col("_u"))
    return chosen.select("_id", host.alias("host"), path.alias("path"))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, bool]],
    default: str = "allow",
    id_column: str = "page_id",
    url_column: str = "url",
    max_bytes: int = 256 << 20,
) -> DataFrame:
    """One row per page: id, host, path, the rule that decides, and its verdict.

    ``rules`` are (host + path, allow?) pairs; a rule fits its host and all subdomains if
    the path of the url starts with the rule's path. The longest wins. A list of more
    than ``max_bytes`` is refused here: use ``filter_urls_sharded``.
    Null, empty and relative urls have an empty host and path and fit no rule; repeated
    rows are judged one by one; a null id stays null; other columns are ignored; an empty
    table gives an empty result; no rules at all give ``default`` everywhere."""
    packed = pack(rules)
    if len(packed) > max_bytes:
        raise ValueError(f"{len(packed)} bytes of rules: use filter_urls_sharded")
    name = f"digests-{uuid.uuid4().hex}.bin"
    publish(pages.sparkSession, name, packed)
    return _hosts_and_paths(pages, id_column, url_column).mapInPandas(
        _mapped(name, default, id_column), _schema(pages, id_column)
    )


def publish(spark: SparkSession, name: str, content: bytes) -> None:
    """Write a file to the shared folder; every executor fetches its own copy from there."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{work_folder(spark)}/{name}")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(content))
    stream.close()
    spark.sparkContext.addFile(path.toString())


def _schema(pages: DataFrame, id_column: str) -> str:
    kind = pages.schema[id_column].dataType.simpleString()
    return f"`{id_column}` {kind}, host string, path string, rule string, verdict string"


def _mapped(name: str, default: str, id_column: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = DigestArray(SparkFiles.get(name))
        for b in batches:
            rule, verdict = judge(b["host"].tolist(), b["path"].tolist(), index, default)
            yield pd.DataFrame(
                {
                    id_column: b["_id"],
                    "host": b["host"].astype(object),
                    "path": b["path"].astype(object),
                    "rule": pd.Series(rule, b.index, object),
                    "verdict": pd.Series(verdict, b.index, object),
                }
            )

    return run


def filter_urls_sharded(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    id_column: str = "page_id",
    url_column: str = "url",
    shards: int = 256,
) -> DataFrame:
    """``filter_urls`` for rule lists of any size: ``rules`` is a table (rule, allow).

    Rules and the distinct probes of all pages meet by the leading bits of their key: a
    task packs the rules of its shard and searches them. ``shards`` should keep a shard
    within a task's memory. Hits, a few at most per host and path, are joined back; the
    distinct path lengths and numbers of labels of the rules are all that the driver holds."""
    host_part = F.substring_index("rule", "/", 1)
    shapes = rules.where("rule is not null").agg(
        F.collect_set(F.octet_length("rule") - F.octet_length(host_part)).alias("lengths"),
        F.collect_set(F.regexp_count(host_part, F.lit("[.]")) + 1).alias("labels"),
    ).first()
    lengths, labels = sorted(shapes["lengths"]), sorted(shapes["labels"])
    urls = stored(
        _hosts_and_paths(pages, id_column, url_column).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "urls",
    )
    shard = F.pmod(F.xxhash64("probe"), F.lit(shards)).alias("shard")

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [
                (h, p, x)
                for h, p in zip(b["host"], b["path"], strict=True)
                for x in probes_of(h, p, lengths, labels)
            ]
            yield pd.DataFrame(out, columns=["host", "path", "probe"], dtype=object)

    probes = urls.select("host", "path").distinct().mapInPandas(
        expand, "host string, path string, probe string"
    )
    wanted = probes.select("probe").distinct().select("probe", shard)
    given = rules.where("rule is not null").select(F.col("rule").alias("probe"), "allow").select(
        "probe", "allow", shard
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        index = DigestArray(pack(list(zip(right["probe"], right["allow"], strict=True))))
        strings = left["probe"].tolist()
        at = index.find([s.encode() for s in strings])
        hit = np.flatnonzero(at >= 0)
        return pd.DataFrame(
            {"probe": [strings[i] for i in hit], "allow": [bool(index.allow[at[i]]) for i in hit]},
            dtype=object,
        )

    hits = (
        wanted.groupBy("shard").cogroup(given.groupBy("shard")).applyInPandas(
            search, "probe string, allow boolean"
        )
    )
    best = (
        probes.join(hits, "probe")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.octet_length("probe").alias("n"), "probe", "allow")).alias("b"))
    )
    return urls.join(best, ["host", "path"], "left").select(
        F.col("_id").alias(id_column),
        "host",
        "path",
        F.col("b.probe").alias("rule"),
        F.when(F.col("b.allow").isNull(), F.lit(default))
        .when(F.col("b.allow"), F.lit("allow"))
        .otherwise(F.lit("block"))
        .alias("verdict"),
    )
