"""URL filtering with sorted digest arrays.

A list of entries (host, path prefix, verdict) becomes shards: 64-bit xxhash keys of the
full entry strings in ascending order, with the strings themselves beside them. A task
puts its shard's keys into a file of its own, memory-maps it, finds the probes by a
vectorised binary search and confirms each hit on the stored string, so that colliding
digests don't count. An entry fits its host and all subdomains if the path starts with
its prefix; of several the longest wins.

Probes are the distinct strings "host suffix + path prefix" for the lengths of prefix
that the list has; each is looked up once however many pages share it. Of a host only as
many labels from the right are tried as the longest listed host has, so a long url costs
no more than a short one.

Defined results: a NULL url, or one without "://", has an empty host and path and fits
nothing. An empty list fits nothing; an empty table gives no rows. Of repeated entries
with different verdicts "block" wins. Rows that repeat are judged each. Columns other
than the named ones play no part.
"""

from __future__ import annotations

import math
import os
import tempfile

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Entries and probes of a shard, on average.
SHARD_ENTRIES, SHARD_PROBES = 1_000_000, 250_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def key_of(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(1 << 30))


def digests(strings: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(s.encode()) for s in strings], np.uint64)


def shards(entries: DataFrame, count: int) -> DataFrame:
    """(shard, keys, ends, strings, blocks): the entries of a shard in one row."""

    def pack(key, frame):
        strings, verdicts = frame["entry"].tolist(), (frame["verdict"] == "block").to_numpy()
        keys = digests(strings)
        order = np.argsort(keys, kind="stable")
        raw = [strings[i].encode() for i in order]
        return pd.DataFrame(
            {
                "shard": [key[0]],
                "keys": [keys[order].tobytes()],
                "ends": [np.cumsum([len(r) for r in raw]).astype(np.int64).tobytes()],
                "strings": [b"".join(raw)],
                "blocks": [verdicts[order].tobytes()],
            }
        )

    distinct = entries.groupBy("entry").agg(F.max("verdict").alias("verdict"))  # "block" is after "allow"
    dealt = distinct.select("entry", "verdict", (key_of(F.col("entry")) % count).alias("shard"))
    return dealt.groupBy("shard").applyInPandas(pack, "shard long, keys binary, ends binary, strings binary, blocks binary")


def look_up(keys: np.ndarray, ends: np.ndarray, strings: bytes, probes: list[str]) -> np.ndarray:
    """Position of each probe among the entries, or -1."""
    found = np.full(len(probes), -1, np.int64)
    if not len(keys):
        return found
    wanted = digests(probes)
    low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
    for i in np.flatnonzero(high > low):
        text = probes[i].encode()
        for j in range(low[i], high[i]):
            if strings[(ends[j - 1] if j else 0) : ends[j]] == text:
                found[i] = j
                break
    return found


def probe(probes: DataFrame, packed: DataFrame) -> DataFrame:
    """(probe, verdict) of the probes (shard, probe) that are entries."""

    def search(key, asked, rows):
        if rows.empty or asked.empty:
            return pd.DataFrame({"probe": [], "verdict": []}, dtype=object)
        row = rows.iloc[0]
        handle, name = tempfile.mkstemp(suffix=".keys")
        try:
            with os.fdopen(handle, "wb") as file:
                file.write(row["keys"])
            keys = np.memmap(name, np.uint64, "r")
            at = look_up(keys, np.frombuffer(row["ends"], np.int64), row["strings"], asked["probe"].tolist())
            del keys
        finally:
            os.unlink(name)
        blocks = np.frombuffer(row["blocks"], bool)
        hit = at >= 0
        verdicts = np.where(blocks[at[hit]], "block", "allow").astype(object)
        return pd.DataFrame({"probe": asked["probe"].to_numpy(object)[hit], "verdict": verdicts}, dtype=object)

    return probes.groupBy("shard").cogroup(packed.groupBy("shard")).applyInPandas(search, "probe string, verdict string")


def match(pages: DataFrame, entries: DataFrame, id_cols: list[str], host: str, path: str) -> DataFrame:
    """The id columns, entry and verdict of the longest fitting entry; a row for each
    row of pages (distinct hosts and paths are looked up once), NULLs without a match.

    entries: host, path, verdict ("allow" or "block").
    """
    listed = stored(entries.select(F.concat("host", "path").alias("entry"), F.length("path").alias("size"), "verdict"), "entries")
    sizes = sorted(r[0] for r in listed.select("size").distinct().collect())
    places = stored(pages.select(F.col(host).alias("host"), F.col(path).alias("path")).where("host != ''").distinct(), "places")
    # The last labels of the host, as many as the longest listed host has.
    deepest = entries.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    labels = F.split(F.substring_index("host", ".", -max(deepest, 1)), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tails = F.filter(F.array(*(F.when(F.length("path") >= s, F.substring("path", 1, s)) for s in sizes)), lambda p: p.isNotNull()) if sizes else F.array().cast("array<string>")
    asked = places.select("host", "path", F.explode(suffixes).alias("suffix"), tails.alias("tails")).select("host", "path", F.explode("tails").alias("tail"), "suffix")
    asked = asked.select("host", "path", F.concat("suffix", "tail").alias("probe"))
    probes = stored(asked.select("probe").distinct(), "probes")
    n = max(1, math.ceil(listed.count() / SHARD_ENTRIES), math.ceil(probes.count() / SHARD_PROBES))
    packed = shards(listed.select("entry", "verdict"), n)
    hits = stored(probe(probes.withColumn("shard", key_of(F.col("probe")) % n), packed), "hits")
    best = asked.join(hits, "probe").groupBy("host", "path").agg(F.max(F.struct(F.length("probe").alias("n"), F.col("probe").alias("entry"), "verdict")).alias("b"))
    best = best.select("host", "path", "b.entry", "b.verdict")
    mine = pages.select(*id_cols, F.col(host).alias("host"), F.col(path).alias("path"))
    return mine.join(best, ["host", "path"], "left").select(*id_cols, "host", "path", "entry", "verdict")
