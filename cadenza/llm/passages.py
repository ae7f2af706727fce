"""Suffix-array dedup: removal of every byte that lies in a string of fixed length found more than once.

Each string has an anchor, the position of the least hash in it, so equal strings have equal anchors at equal places. Texts
are cut at anchors into segments; segments whose anchor occurs once in the corpus hold nothing repeated, and where all
segments of an anchor are equal all of their strings repeat. The others meet in shards by anchor, one copy of each distinct
segment, and a shard's suffix array tells which strings repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import arrow_schema, heavy_join, in_batches, kept, read, whole_row
from cadenza.llm.suffix import repeated_starts

#: Bytes of a repeated string of op 9, and of one of the pipeline's stage: passages of over 50 words have 200 bytes or more
#: unless their words have under three letters.
LENGTH, STAGE_LENGTH = 400, 200
#: Bytes hashed for an anchor: so many that few grams are met twice by chance.
GRAM = 32
#: Bytes of segments in a shard, about.
SHARD_BYTES = 2 << 20
#: An anchor whose distinct segments hold more bytes than this is settled by digests of its single strings, not in a shard.
ANCHOR_BYTES = 4 << 20
_CHUNK = 1 << 19


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each position."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    width, factor = 1, 0xD6E8FEB86659FD93
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        h ^= h >> np.uint64(29)
        factor = factor * 0xBF58476D1CE4E5B9 % (1 << 64) | 1
        width *= 2
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _sliding_least(a: np.ndarray, width: int) -> np.ndarray:
    n = len(a)
    rows = -(-n // width)
    square = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    square[:n] = a
    square = square.reshape(rows, width)
    after = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    upto = np.minimum.accumulate(square, axis=1).ravel()
    return np.minimum(after[: n - width + 1], upto[width - 1 : n])


def segments(data: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """(first, last, anchor, hash): strings from first to last share the anchor. Nothing for texts under length."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < length:
        return
    hashes = _gram_hashes(raw)
    width = length - GRAM + 1
    low = np.uint64((1 << 20) - 1)
    found: list[np.ndarray] = []
    for c in range(0, len(raw) - length + 1, _CHUNK):
        part = hashes[c : c + _CHUNK + width - 1]
        packed = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        found.append((_sliding_least(packed, width) & low).astype(np.int64) + c)
    anchors = np.concatenate(found)
    first = np.concatenate([[0], np.flatnonzero(np.diff(anchors)) + 1])
    last = np.concatenate([first[1:] - 1, [len(anchors) - 1]])
    at = anchors[first]
    yield from zip(first.tolist(), last.tolist(), at.tolist(), hashes[at].view(np.int64).tolist(), strict=True)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _digest(data: bytes, seed: int) -> tuple[int, int]:
    import xxhash

    d = xxhash.xxh3_128_intdigest(data, seed)
    return _signed(d >> 64), _signed(d & ((1 << 64) - 1))


def _find_segments(length: int):
    names = ("k1", "k2", "first", "size", "h", "d1", "d2")

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in names}
            for k1, k2, text in zip(b["k1"], b["k2"], b["text"], strict=True):
                data = (text or "").encode()
                for first, last, anchor, h in segments(data, length):
                    size = last - first + length
                    d1, d2 = _digest(data[first : first + size], anchor - first)
                    for k, v in zip(names, (k1, k2, first, size, h, d1, d2), strict=True):
                        out[k].append(v)
                if len(out["h"]) >= 50_000:
                    yield out
                    out = {k: [] for k in names}
            yield out

    return run


def _take(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
    """Bytes of the wanted segments of each text."""
    for b in batches:
        for text, wanted in zip(b["text"], b["wanted"], strict=True):
            data = text.encode()
            yield {k: [w[k] for w in wanted] for k in ("h", "d1", "d2", "n")} | {
                "data": [data[w["first"] : w["first"] + w["size"]] for w in wanted]
            }


def _ranges(starts: np.ndarray) -> list[int]:
    """First and last of each run of consecutive numbers, one after the other."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return np.stack([starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]]], axis=1).ravel().tolist()


def _shard(schema: pa.Schema, length: int):
    def run(table: pa.Table) -> pa.Table:
        data, times = table["data"].to_pylist(), table["n"].to_pylist()
        found = [
            [0, len(d) - length] if n > 1 else _ranges(r)
            for d, n, r in zip(data, times, repeated_starts(data, length), strict=True)
        ]
        columns = [table[k].combine_chunks() for k in ("h", "d1", "d2", "n")]
        return pa.Table.from_arrays([*columns, pa.array(found, pa.list_(pa.int32()))], schema=schema)

    return run


def _strings(length: int):
    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        """Digest of every single string of a segment."""
        for b in batches:
            for h, d1, d2, n, data in zip(*(b[k] for k in ("h", "d1", "d2", "n", "data")), strict=True):
                count = len(data) - length + 1
                own = [_digest(data[i : i + length], 0) for i in range(count)]
                yield {
                    "h": [h] * count, "d1": [d1] * count, "d2": [d2] * count, "n": [n] * count, "i": list(range(count)),
                    "w1": [x for x, _ in own], "w2": [y for _, y in own],
                }

    return run


def _cleared(text: str | None, places: list[dict] | None, length: int) -> tuple[bytes, int, int]:
    """Bytes that stay, bytes removed, runs removed."""
    data = (text or "").encode()
    spans = sorted(
        (p["first"] + r[i], p["first"] + r[i + 1] + length)
        for p in (() if places is None else places)
        for r in [p["ranges"]]
        for i in range(0, len(r), 2)
    )
    out, at, removed, runs, reach = [], 0, 0, 0, -1
    for a, b in spans:
        if a > reach:
            out.append(data[at:a])
            runs += 1
            removed += b - a
        else:
            removed += max(0, b - reach)
        reach = max(reach, b)
        at = reach
    out.append(data[at:])
    return b"".join(out), removed, runs


def repeated_places(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, places array<struct<first, ranges>>) for texts of docs (k1, k2, text) that hold repeated strings.

    k1, k2 identify the text by its content, so copies of a document count as often as they stand in docs; ranges are
    pairs of first and last start, from first on. An anchor, or a segment, with a great share of all rows is joined on the
    spot and never gathered.
    """
    spark = docs.sparkSession
    found = kept(
        in_batches(
            docs.select("k1", "k2", "text"),
            _find_segments(length),
            "k1 bigint, k2 bigint, first bigint, size int, h bigint, d1 bigint, d2 bigint",
        )
    )
    total = found.count()
    often = kept(
        found.groupBy("h")
        .agg(
            F.count("*").alias("times"),
            ((F.min("d1") < F.max("d1")) | (F.min("d2") < F.max("d2"))).alias("mixed"),
        )
        .where("times > 1")
    )
    shared = kept(heavy_join(found, often, ["h"], "times", total).drop("times"))
    key = ["h", "d1", "d2"]
    kinds = shared.where("mixed").groupBy(*key).agg(
        F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("k1", "k2", "first", "size"))
    )
    kinds = kept(kinds)
    by_anchor = kinds.groupBy("h").agg(F.sum("size").alias("bytes"))
    hot = kept(by_anchor.where(F.col("bytes") > ANCHOR_BYTES).select("h"))
    volume = kinds.agg(F.sum("size")).first()[0] or 0
    wanted = kept(kinds.groupBy("k1", "k2").agg(F.collect_list(F.struct(*key, "n", "first", "size")).alias("wanted")))
    taken = in_batches(
        docs.join(wanted, ["k1", "k2"]).select("text", "wanted"),
        _take,
        "h bigint, d1 bigint, d2 bigint, n bigint, data binary",
    )
    # copies of a text give its segments again
    once = kept(taken.groupBy(*key).agg(F.first("n").alias("n"), F.first("data").alias("data")))
    shards = max(1, -(-volume // SHARD_BYTES))
    cold = once.join(hot, "h", "left_anti").withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))
    schema = "h bigint, d1 bigint, d2 bigint, n bigint, ranges array<int>"
    ranges = cold.groupBy("shard").applyInArrow(_shard(arrow_schema(spark, schema), length), schema)
    if not hot.isEmpty():
        ranges = ranges.unionByName(_by_string(once.join(hot, "h", "left_semi"), key, length))
    held = kept(ranges.where("size(ranges) > 0"))
    in_mixed = heavy_join(shared.where("mixed"), held, key, "n", total).select("k1", "k2", "first", "ranges")
    whole = F.array(F.lit(0), F.col("size") - length)
    alike = shared.where("not mixed").select("k1", "k2", "first", whole.alias("ranges"))
    return in_mixed.unionByName(alike).groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "ranges")).alias("places"))


def _by_string(rows: DataFrame, key: list[str], length: int) -> DataFrame:
    each = in_batches(rows, _strings(length), "h bigint, d1 bigint, d2 bigint, n bigint, i int, w1 bigint, w2 bigint")
    again = each.groupBy("w1", "w2").agg(F.sum("n").alias("times")).where("times > 1").select("w1", "w2")
    return (
        each.join(again, ["w1", "w2"])
        .groupBy(*key)
        .agg(F.first("n").alias("n"), F.flatten(F.array_sort(F.collect_list(F.array("i", "i")))).alias("ranges"))
    )


def remove_repeated(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with __clear: struct<n_bytes, n_removed, n_spans, kept_sha256, kept_text> for each row.

    Every byte of a text, as UTF-8, that lies in a string of length bytes which also starts anywhere else, in the same text
    or in another row, is removed from all of its places. kept_text is what stays, without characters that were cut through.
    Null text is empty. Rows that repeat a text are found twice, so both lose it. Texts under length bytes stay whole.
    An empty table gives none. Other columns are passed on, whatever their names; one called __clear is replaced.
    """
    return _with_clear(docs.drop("__clear"), text, length).select("row.*", F.col("clear").alias("__clear"))


def _with_clear(docs: DataFrame, text: str, length: int) -> DataFrame:
    """(row, clear): all columns of docs in one struct, and what remove_repeated finds."""
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        whole_row(docs),
        whole.alias("text"),
        F.xxhash64(whole).alias("k1"),
        F.xxhash64(F.lit(length), whole, F.lit(1)).alias("k2"),
    )
    texts = keyed.select("k1", "k2", "text")
    places = kept(repeated_places(texts, length))
    # copies of a text with a great share of all rows need no join: each string of theirs is in the next copy
    copies = kept(keyed.groupBy("k1", "k2").agg(F.count("*").alias("copies")).where("copies > 1"))
    last = F.octet_length("text") - length
    all_of_it = F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.array(F.lit(0), last).alias("ranges")))
    joined = heavy_join(
        keyed, copies, ["k1", "k2"], "copies", docs.count(),
        rest=lambda rows, _: rows.join(places, ["k1", "k2"], "left"),
        hot=lambda rows: rows.withColumn("places", F.when(last >= 0, all_of_it)),
    ).select("row", "text", "places")

    @F.pandas_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string")
    def clear(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, where in batches:
            rows = []
            for t, p in zip(texts, where, strict=True):
                data, removed, runs = _cleared(t, p, length)
                rows.append(
                    (len(data) + removed, removed, runs, hashlib.sha256(data).hexdigest(), data.decode(errors="ignore"))
                )
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return joined.select("row", clear("text", "places").alias("clear"))


def op9_passages(spark, sf_dir: str) -> DataFrame:
    """What remove_repeated leaves of each document; text, the last column, is the kept text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated(docs).select(
        "doc_id", "__clear.n_bytes", "__clear.n_removed", "__clear.n_spans", "__clear.kept_sha256",
        F.col("__clear.kept_text").alias("text"),
    )


def passages_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of STAGE_LENGTH bytes that repeat; n_chars follows. Documents of which nothing is left stay, empty.

    Null text stays null, and so does a null n_chars. Rows that repeat a text lose it, all of them.
    """
    cleared = _with_clear(docs, "text", STAGE_LENGTH)
    kept_text, row = F.col("clear.kept_text"), F.col("row")
    new = {"text": F.when(row["text"].isNotNull(), kept_text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(row["n_chars"].isNotNull(), F.char_length(kept_text).cast(docs.schema["n_chars"].dataType))
    return cleared.select(*(new.get(c, row.getField(c)).alias(c) for c in docs.columns))
