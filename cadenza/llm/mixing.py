"""Mixing sources to target weights: whole copies of documents by pivotal dependent rounding.

A document's expected copies are its source's target over its source's size. The fractional rest is a mass of words between
none and the whole document. Pivotal steps move mass between two documents at random, without bias, until one of them has
none or all; what remains of a block, one document, goes up a reduction tree. Words are kept at every step, so that a source
misses its target by part of the one document that is left at its root.

So that this last document is small against its source, documents of over 1/LARGE of their source's words, fewer than LARGE a
source, are rounded first, in falling classes of size: every class takes its share of what is left of the target.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import WORD, arrow_schema, cut, heavy_join, kept, read

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
LARGE = 1000
DRAWS = 64
GOLDEN = 0.6180339887498949
#: Documents of a block, and residuals that meet in one block of the next level.
ROWS = 20_000
FAN = 256


def transfer(s: int, m: float, t: int, n: float, u: float) -> tuple[float, float]:
    """One pivotal step: masses m of s words and n of t words, both fractional, after a random move; u is uniform in [0, 1).

    The move is as far as it goes in one of two directions, with the chances that leave both masses' means alone.
    """
    up, down = min(s - m, n), min(m, t - n)
    if u * (up + down) < down:
        return (s, n - up) if s - m <= n else (m + up, 0.0)
    return (0.0, n + down) if m <= t - n else (m - down, t)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df and each row's place in the order, from 0: sorted by ranges, then shifted by what stands in earlier ranges."""
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(name, 33)
    counts = sorted(placed.groupBy(part.alias("part")).count().collect())  # a row for each partition
    starts, before = [], 0
    for p, n in counts:
        starts.append((p, before))
        before += n
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "part bigint, start bigint"))
    local = F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part", part).join(offsets, "part").withColumn(name, local + F.col("start")).drop("part", "start")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sizes (source, source_size) with weight and target; sources in code point order, null last, take the weights in turn.

    Targets share share times all words by weight and stop at most times their source; the excess goes to the others by
    weight until none is above. That is one level of words a weight, raised until the set of full sources stays. Empty
    sources get none; without words all targets are 0.
    """
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ranked = numbered(sizes, [F.col("source").isNull(), F.col("source")], "place")
    ranked = cut(ranked.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))).drop("place"))
    cap = F.col("source_size") * float(most)
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        over = F.lit(level) * F.col("weight") > cap
        taken, rest, n = ranked.agg(
            F.sum(F.when(over, cap).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))), F.count_if(over)
        ).first()
        if n == full or not rest:
            break
        level, full = (total - taken) / rest, n
    return ranked.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap))


def _uniform(*what: Column) -> Column:
    """In [0, 1), from 53 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(*what), 11) / float(1 << 53)


def _round_class(size: list[int], rate: float, u: list[float], last: list[float]) -> list[int]:
    """Copies for documents of one class in memory, each worth rate on the average; the last one left is drawn."""
    base = int(rate)
    extra, at, mass = [0] * len(size), None, 0.0
    for j, s in enumerate(size):
        m = (rate - base) * s
        if not 0 < m < s:
            continue
        if at is None:
            at, mass = j, m
            continue
        t = size[at]
        mass, m = transfer(t, mass, s, m, u[j])
        if 0 < mass < t:
            extra[j] = int(m > 0)
            continue
        extra[at] = int(mass > 0)
        at, mass, extra[j] = (j, m, 0) if 0 < m < s else (None, 0.0, int(m > 0))
    if at is not None:
        extra[at] = int(last[at] * size[at] < mass)
    return [base + x for x in extra]


def _draw(size: list[int], target: float, left: int, most: float, u: list[float], last: list[float]) -> tuple[list[int], float]:
    """One draw for documents in falling size: copies, and the words that no document left can mend any more."""
    taken, copies = 0, []
    for _, places in groupby(range(len(size)), lambda i: size[i].bit_length()):
        at = list(places)
        some = [size[i] for i in at]
        rate = min(max((target - taken) / left, 0.0), most)
        got = _round_class(some, rate, [u[i] for i in at], [last[i] for i in at])
        copies += got
        taken += sum(c * s for c, s in zip(got, some, strict=True))
        left -= sum(some)
    return copies, max(taken - target, target - taken - most * left, 0.0)


def _cascade(most: float, shape: list[str]):
    """Copies for one source's large documents, fewer than LARGE: class by class, each with its share of what is left.

    A draw that misses the target by more than a document that is not large is drawn again, at most DRAWS times in all; the
    nearest stays.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("size", "descending"), ("h", "ascending")])
        size, u, last = (rows[c].to_pylist() for c in ("size", "u", "last"))
        target, left = rows["target"][0].as_py(), rows["source_size"][0].as_py()
        best, least = None, None
        for k in range(DRAWS):
            turned = [[(x + k * GOLDEN) % 1 for x in some] for some in (u, last)]
            copies, miss = _draw(size, target, left, most, *turned)
            if best is None or miss < least:
                best, least = copies, miss
            if least * LARGE <= left:
                break
        return rows.select(shape).append_column("copies", pa.array(best, pa.int64()))

    return run


def _block_rounding(kinds: pa.Schema):
    """Sorted rows (name, block, size, base, mass, u): copies for all but one fractional document of each block.

    Reads its rows as a stream: at any time one fractional document is held, moved to the front of the next batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if held is not None:
                b = pa.concat_batches([held, b])
            name, block, size, u, mass = (b.column(c).to_pylist() for c in ("name", "block", "size", "u", "mass"))
            whole, at = [None] * len(size), None  # the fractional part as 0 or 1, if decided
            for j, s in enumerate(size):
                if at is not None and (name[at] != name[j] or block[at] != block[j]):
                    at = None  # its block's residual
                m = mass[j]
                if not 0 < m < s:
                    whole[j] = int(m > 0)
                elif at is None:
                    at = j
                else:
                    t = size[at]
                    mass[at], mass[j] = transfer(t, mass[at], s, m, u[j])
                    here = 0 < mass[at] < t
                    if not here:
                        whole[at] = int(mass[at] > 0)
                    if not 0 < mass[j] < s:
                        whole[j] = int(mass[j] > 0)
                    at = at if here else j if whole[j] is None else None
            out = _with(b, whole, mass, kinds)
            held = None
            if at is not None:
                held = _with(b.slice(at, 1), None, mass[at : at + 1], b.schema)
                out = out.filter(pa.array([i != at for i in range(len(size))]))
            yield out
        if held is not None:
            yield _with(held, [None], held.column("mass").to_pylist(), kinds)

    return run


def _with(b: pa.RecordBatch, whole: list | None, mass: list, schema: pa.Schema) -> pa.RecordBatch:
    """The batch's columns of schema, with mass and the decisions put in."""
    new = {"mass": pa.array(mass, pa.float64()), "whole": pa.array(whole, pa.int64()) if whole is not None else None}
    return pa.RecordBatch.from_arrays([b.column(f.name) if new.get(f.name) is None else new[f.name] for f in schema], schema=schema)


def mix(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 42,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, h), a row for each row of docs: how often the mix takes it.

    Sizes are words, 0 for a null text. Copies are whole, from 0 to most, and depend on the rows alone, not on their order
    or partitions; expected copies are target over source_size. Equal rows are as good as each other and get what chance
    gives each. Null sources are one source, null ids are ids; an empty table gives none, wordless documents no copies.
    Other columns are ignored. h is a digest of the row's text.
    """
    rows = kept(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source).cast("string"))).alias("name"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.xxhash64(F.lit(seed), F.col(text), F.col(doc_id), F.col(source)).alias("h"),
        )
    )
    per = cut(rows.groupBy("name").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("n")))
    targets = cut(source_targets(per, weights, share, most).select("name", "source_size", "target", "n"))
    total = targets.agg(F.sum("n")).first()[0] or 0
    placed = heavy_join(rows, targets, ["name"], "n", total).drop("n")
    large = F.col("size") * LARGE > F.col("source_size")

    shape = ["doc_id", "source", "name", "size", "h", "source_size", "target"]
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in shape)
    first = placed.where(large).withColumns({"u": _uniform(F.col("h"), F.lit(-1)), "last": _uniform(F.col("h"), F.lit(-2))})
    big = kept(first.groupBy("name").applyInArrow(_cascade(float(most), shape), f"{schema}, copies bigint"))

    used = big.groupBy("name").agg(F.sum("size").alias("seen"), F.sum(F.col("size") * F.col("copies")).alias("taken"), F.count("*").alias("m"))
    left = F.col("source_size") - F.coalesce("seen", F.lit(0))
    owed = (F.col("target") - F.coalesce("taken", F.lit(0))) / left
    rates = cut(
        targets.join(used, "name", "left").select(
            "name", "source_size", "target", "n", F.when(left > 0, F.least(F.greatest(owed, F.lit(0.0)), F.lit(float(most)))).otherwise(0.0).alias("rate"),
            F.greatest(F.ceil((F.col("n") - F.coalesce("m", F.lit(0))) / ROWS), F.lit(1)).cast("bigint").alias("blocks"),
        )
    )
    rest = heavy_join(rows, rates, ["name"], "n", total).where(~large)
    base = F.floor("rate").cast("bigint")
    level = rest.select(
        *shape, base.alias("base"), ((F.col("rate") - base) * F.col("size")).alias("mass"), F.pmod("h", "blocks").alias("block")
    )
    most_blocks = rates.agg(F.max("blocks")).first()[0] or 0
    schema = f"{schema}, base bigint, mass double, block bigint, whole bigint"
    decided, k = [], 0
    while most_blocks:
        ready = level.withColumn("u", _uniform(F.col("h"), F.lit(k))).repartition("name", "block")
        ready = ready.sortWithinPartitions("name", "block", "h", "doc_id")
        out = kept(ready.mapInArrow(_block_rounding(arrow_schema(docs.sparkSession, schema)), schema))
        decided.append(out.where("whole is not null"))
        level = out.where("whole is null").withColumn("block", F.expr(f"block div {FAN}")).drop("whole")
        if most_blocks == 1:
            break
        most_blocks, k = -(-most_blocks // FAN), k + 1
    if most_blocks:  # one document a source is left
        chance = _uniform(F.col("h"), F.lit(-2)) * F.col("size")
        decided.append(level.withColumn("whole", (chance < F.col("mass")).cast("bigint")))
    shape = [c for c in shape if c != "name"] + ["copies"]
    result = big.select(*shape)
    for d in decided:
        result = result.unionByName(d.withColumn("copies", F.col("base") + F.col("whole")).select(*shape))
    return result


def mixture(docs: DataFrame, seed: int = 42, **options) -> DataFrame:
    """The mixed corpus: every row of docs as often as mix() takes it, with copy counted from 1. Columns of docs stay.

    options are those of mix(). Equal rows share their copies: the first of them stands for all.
    """
    text, source, doc_id = (options.get(c, c) for c in ("text", "source", "doc_id"))
    taken = mix(docs, seed=seed, **options).where("copies > 0").groupBy("doc_id", "h").agg(F.sum("copies").alias("n"))
    row = F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")
    h = F.xxhash64(F.lit(seed), F.col(text), F.col(doc_id), F.col(source))
    keyed = docs.select(row, F.col(doc_id).alias("id"), h.alias("key")).dropDuplicates(["id", "key"])
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("h"))
    return keyed.join(taken, same).select("row.*", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("copy"))


def op11_mixing(spark, sf_dir: str) -> DataFrame:
    out = mix(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
