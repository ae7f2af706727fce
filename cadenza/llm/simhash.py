"""SimHash near-duplicates: 64-bit fingerprints of three-word shingles, found by pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import cut, heavy_join, in_batches, row_digest, row_key, whole_row
from cadenza.llm.graph import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Of BLOCKS blocks, MAX_BITS differing bits leave BLOCKS - MAX_BITS untouched; each choice of so many blocks is one table.
BLOCKS = 4
#: A block bucket with more fingerprints than this is linked through shared one-bit neighbours instead of pairs.
BUCKET = 64


def fingerprint(text: str | None) -> int:
    """Signed 64-bit fingerprint of one text; null or no words: 0."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
        n = len(words) - SHINGLE + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 255):  # so many ones fit a byte
        counts += np.add.reduce(bits[i : i + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns and fp long, a row for each row of docs."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", fp bigint"

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield {c: b[c] for c in keep} | {"fp": [fingerprint(t) for t in b[text]]}

    return in_batches(docs.select(*keep, text), work, schema)


def near_links(classes: DataFrame) -> DataFrame:
    """(a, b): links that connect all classes (fp, id) whose fingerprints differ in MAX_BITS bits or fewer.

    Blocks are joined pairwise and verified where a bucket is small. A larger bucket would make pairs by the square, so
    its fingerprints are sent to themselves and their 64 one-bit neighbours: two fingerprints meet there exactly if
    they differ in two bits or fewer, at most 65 meet in one place, and each is linked with the smallest id there.
    """
    width = 64 // BLOCKS
    tables = list(combinations(range(BLOCKS), BLOCKS - MAX_BITS))

    def key(blocks: tuple[int, ...]) -> Column:
        out = F.lit(0).cast("bigint")
        for i in blocks:
            out = F.shiftleft(out, width).bitwiseOR(
                F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1))
            )
        return out

    keys = F.array(*(F.struct(F.lit(t).alias("t"), key(b).alias("k")) for t, b in enumerate(tables)))
    blocks = classes.select("fp", "id", F.explode(keys).alias("e")).select("fp", "id", "e.t", "e.k")
    sizes = cut(blocks.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    shared = cut(heavy_join(blocks, sizes, ["t", "k"], "n", total))

    few = shared.where(F.col("n") <= BUCKET)
    left, right = few.alias("l"), few.alias("r")
    close = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= MAX_BITS
    met = (F.col("l.t") == F.col("r.t")) & (F.col("l.k") == F.col("r.k")) & (F.col("l.id") < F.col("r.id"))
    pairs = left.join(right, met & close).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))

    many = shared.where(F.col("n") > BUCKET).select("fp", "id").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *(F.shiftleft(F.lit(1).cast("bigint"), i) for i in range(64)))
    spots = many.select("id", F.explode(flips).alias("flip"), "fp").select(
        "id", F.col("fp").bitwiseXOR(F.col("flip")).alias("spot")
    )
    met_at = spots.groupBy("spot").agg(F.min("id").alias("b"), F.collect_list("id").alias("ids")).where("size(ids) > 1")
    stars = met_at.select(F.explode("ids").alias("a"), "b").where("a <> b")
    return pairs.unionByName(stars).distinct()


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs.

    Fingerprints in MAX_BITS bits of each other link; component_id is the smallest id reachable. Equal fingerprints are
    one class before anything is joined, so copies cost no links. Null, empty and wordless texts have fingerprint 0 and
    link like any other. Rows that repeat an id belong to one component. An empty table gives none. A null id takes part
    without a number of its own: its row gets the component of the others, or null. Other columns are ignored.
    """
    rows = cut(fingerprints(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), keep=("id",)))
    classes = rows.groupBy("fp").agg(F.min("id").alias("id"))
    again = rows.where("id is not null").groupBy("id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
    same_id = again.where("lo <> hi").select("id").join(rows, "id").select("id", "fp").distinct()
    bridges = same_id.join(classes.withColumnRenamed("id", "b"), "fp").select(F.col("id").alias("a"), "b")
    found = components(near_links(classes).unionByName(bridges))
    named = classes.join(found, classes["id"] == found["node"], "left").select(
        "fp", F.coalesce("component", "id").alias("component_id")
    )
    return rows.join(named, "fp").select(F.col("id").alias("doc_id"), "fp", "component_id")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    from cadenza.llm.common import read

    out = simhash_groups(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the one with the smallest id, null last, then the smallest digest; of equal rows one.

    Groups are those of simhash_groups, except that fingerprints name them, so that rows without an id link like any other.
    """
    key = ("none", "doc_id", "digest", "other")
    full = docs.select(whole_row(docs), row_key("doc_id").alias("k"), row_digest(docs).alias("other"), "text")
    full = full.select(
        "row", "text", F.struct(F.col("k.doc_id").isNull().alias("none"), "k.doc_id", "k.digest", "other").alias("key")
    )
    rows = cut(fingerprints(full.select("key.*", "text"), keep=key))
    classes = cut(rows.groupBy("fp").agg(F.min(F.struct("none", "doc_id", "other", "digest")).alias("first")))
    again = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("hi"))
    bridges = again.where("a <> hi").join(rows, "doc_id").select("a", F.col("fp").alias("b")).where("a <> b").distinct()
    found = components(near_links(classes.select("fp", F.col("fp").alias("id"))).unionByName(bridges))
    named = classes.join(found, classes["fp"] == found["node"], "left")
    first = named.groupBy(F.coalesce("component", "fp")).agg(F.min("first").alias("first"))
    chosen = first.select(F.struct(*(F.col(f"first.{c}") for c in key)).alias("key"))
    return full.drop("text").dropDuplicates(["key"]).join(chosen, "key", "left_semi").select("row.*")
