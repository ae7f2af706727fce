"""A prefix trie over conversations: double arrays per prefix shard, upper nodes merged globally.

Conversations are sequences of turns (role, text), named by digests. Equal sequences are one row with their members' number
and least id before anything else. A shard holds the sequences that share a prefix, cut as deep as its turns need to stay
under SHARD; the task that reads it numbers its turns densely, packs BASE and CHECK, and walks every sequence through them.
Nodes above the shards' prefixes are summed over all shards by their prefix' digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import WORD, arrow_schema, cut, heavy_join, kept, read

#: Turns of distinct sequences in a shard, at most, unless one sequence has more.
SHARD = 20_000
#: Conversation ids listed in one piece for the hash of a node's ends.
PIECE = 4096
#: Hot prefixes meet their rows in so many parts.
SALT = 32
#: Free places tried for a node's children before they go behind all others.
TRIES = 64

EMPTY = hashlib.sha256(b"").hexdigest()
SEQ = "array<struct<turn:binary,words:bigint>>"


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that stand for (role, text)."""
    return F.substring(F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, 16)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): each conversation's turns (conv_id, turn, role, text) in order, null turns first.

    Null roles and texts are empty; of turns with one number, the smaller role, then text is first. Rows without a conv_id
    go. Other columns are ignored.
    """
    t = turns.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    each = t.select("conv_id", place.alias("i"), turn_digest(F.col("role"), F.col("text")).alias("turn"), words.alias("words"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "turn", "words")))
    return each.groupBy("conv_id").agg(F.transform(ordered, lambda x: F.struct(x["turn"].alias("turn"), x["words"].alias("words"))).alias("seq"))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """(conv_id, seq): the first h turns of conversation c-c%20, then c's own turns after its first h; h = crc32(c) % 4."""
    own = seqs.select(
        "conv_id", "seq", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int").alias("h"),
        (F.col("conv_id") - F.col("conv_id") % 20).alias("base"),
    )
    heads = seqs.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("seq", 1, 3).alias("head"))
    head = F.coalesce("head", F.lit([]).cast(SEQ))
    after = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(F.slice(head, F.lit(1), F.col("h")), after).alias("seq"))


def _key(seq: Column) -> Column:
    """16 bytes that stand for a sequence or prefix."""
    turns = F.transform(seq, lambda x: F.hex(x["turn"]))
    return F.substring(F.unhex(F.sha2(F.array_join(turns, "").cast("binary"), 256)), 1, 16)


def _ends(convs: DataFrame) -> DataFrame:
    """(path, seq, n, least, ends): distinct sequences with their members' number, least id, and the hash of their ids.

    Ids are listed in pieces of at most PIECE neighbours; the pieces of one sequence are read in order as a stream.
    """
    schema = "path binary, seq " + SEQ + ", n bigint, least bigint, ends string"
    kinds = arrow_schema(convs.sparkSession, schema)
    piece = F.floor(F.col("conv_id") / PIECE).alias("piece")
    ids = F.array_sort(F.collect_list("conv_id"))
    pieces = convs.withColumn("path", _key(F.col("seq"))).groupBy("path", piece).agg(F.first("seq").alias("seq"), ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = None
        for b in batches:
            out: list[tuple] = []
            for now, seq, ids in zip(*(b.column(c) for c in ("path", "seq", "ids")), strict=True):
                now, ids = now.as_py(), ids.as_py()
                text = ",".join(map(str, ids)).encode()
                if now == path:
                    digest.update(b"," + text)
                    n += len(ids)
                    continue
                if path is not None:
                    out.append((path, held, n, least, digest.hexdigest()))
                path, held, n, least, digest = now, seq.as_py(), len(ids), ids[0], hashlib.sha256(text)
            yield _batch(out, kinds)
        if path is not None:
            yield _batch([(path, held, n, least, digest.hexdigest())], kinds)

    return pieces.repartition("path").sortWithinPartitions("path", "piece").mapInArrow(run, schema)


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)


def _depths(paths: DataFrame, limit: int) -> DataFrame:
    """paths with top, the depth of its shard's prefix: the first of 1, 2, 4, … whose prefix has at most limit turns below.

    Sequences that end above have top one over their length: all of their nodes are upper ones.
    """
    length = F.size("seq")
    open_, done, depth = paths.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALT))), [], 1
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<bigint>")).alias("salt")
    while True:
        done.append(open_.where(length < depth).withColumn("top", length + 1))
        here = open_.where(length >= depth).withColumn("prefix", _key(F.slice("seq", 1, depth)))
        turns = F.sum(length - (depth - 1))
        hot = cut(here.groupBy("prefix").agg(turns.alias("below"), F.count("*").alias("k")).where(F.col("below") > limit).where("k > 1"))
        done.append((here if hot.isEmpty() else here.join(hot.select("prefix", salts), ["prefix", "salt"], "left_anti")).drop("prefix").withColumn("top", F.lit(depth)))
        if hot.isEmpty():
            break
        open_ = cut(here.join(hot.select("prefix", salts), ["prefix", "salt"], "left_semi").drop("prefix"))
        depth *= 2
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("salt")


class DoubleArray:
    """BASE and CHECK over codes from 1: the child of s by code c stands at BASE[s] + c if CHECK there is s."""

    def __init__(self, sequences: list[list[int]]) -> None:
        """sequences in rising order, without repeats."""
        self.base, self.check, self.free = [0, 0], [0, -1], 2  # state 1 is the root; no place under free is free
        self.order = [1]
        level = [(1, 0, len(sequences), 0)]
        while level:
            below = []
            for state, lo, hi, depth in level:
                while lo < hi and len(sequences[lo]) == depth:
                    lo += 1
                spans, start = [], lo
                for i in range(lo + 1, hi + 1):
                    if i == hi or sequences[i][depth] != sequences[start][depth]:
                        spans.append((sequences[start][depth], start, i))
                        start = i
                if spans:
                    self.base[state] = at = self._place([c for c, _, _ in spans])
                    for c, a, b in spans:
                        self._grow(at + c)
                        self.check[at + c] = state
                        self.order.append(at + c)
                        below.append((at + c, a, b, depth + 1))
            level = below

    def _grow(self, place: int) -> None:
        more = place + 1 - len(self.check)
        if more > 0:
            self.base += [0] * more
            self.check += [0] * more

    def _place(self, codes: list[int]) -> int:
        """A base that puts all codes on free places: the first of a few, else behind everything."""
        while self.free < len(self.check) and self.check[self.free]:
            self.free += 1
        place = self.free
        for _ in range(TRIES):
            at = place - codes[0]
            if at >= 0 and all(at + c >= len(self.check) or not self.check[at + c] for c in codes):
                return at
            place += 1
            while place < len(self.check) and self.check[place]:
                place += 1
        return max(len(self.check) - codes[0], 0)

    def step(self, state: int, code: int) -> int:
        """The child of state by code, or 0."""
        place = self.base[state] + code
        return place if place < len(self.check) and self.check[place] == state else 0


def shard_nodes(rows: list[tuple]) -> list[dict]:
    """Nodes of one shard's sequences (seq below the shard's parent as (turn, words) pairs, n, least, ends), parents first.

    Each node has parent (its place in the list, or None), depth from 1, turn, words, least, n, children, leaves, saved, ends.
    """
    seen: dict[bytes, int] = {}
    for seq, *_ in rows:
        for turn, _ in seq:
            seen.setdefault(turn, len(seen) + 1)
    coded = sorted(([seen[t] for t, _ in seq], r) for r, (seq, *_) in enumerate(rows))
    trie = DoubleArray([codes for codes, _ in coded])
    size = len(trie.check)
    n, least, ends = [0] * size, [0] * size, [EMPTY] * size
    depth, words, turn = [0] * size, [0] * size, [b""] * size
    for codes, r in coded:
        seq, members, first, hashed = rows[r]
        state = 1
        for d, (c, (t, w)) in enumerate(zip(codes, seq, strict=True), 1):
            state = trie.step(state, c)
            least[state] = min(least[state], first) if n[state] else first
            n[state] += members
            depth[state], words[state], turn[state] = d, w, t
        ends[state] = hashed
    children, leaves = [0] * size, [0] * size
    saved = [(n[s] - 1) * words[s] for s in range(size)]
    for s in reversed(trie.order[1:]):
        leaves[s] += not children[s]
        up = trie.check[s]
        children[up] += 1
        leaves[up] += leaves[s]
        saved[up] += saved[s]
    at = {s: i for i, s in enumerate(trie.order[1:])}
    return [
        {
            "parent": at.get(trie.check[s]), "depth": depth[s], "turn": turn[s], "words": words[s], "least": least[s], "n": n[s],
            "children": children[s], "leaves": leaves[s], "saved": saved[s], "ends": ends[s],
        }
        for s in trie.order[1:]
    ]


NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint,"
    " saved_tokens bigint, ends_sha256 string, turn binary, words bigint"
)
UP = "shard binary, above binary, prefix " + SEQ + ", top bigint"


def _shards(ready: DataFrame) -> DataFrame:
    """Nodes of sorted shards; each shard's first one, at its prefix, also has shard, above, prefix and top."""
    schema = f"{NODE}, {UP}"
    kinds = arrow_schema(ready.sparkSession, schema)

    def close(rows: list[dict]) -> list[tuple]:
        top, shard, above = rows[0]["top"], rows[0]["shard"], rows[0]["above"]
        prefix = rows[0]["seq"][: top - 1]
        nodes = shard_nodes([([(x["turn"], x["words"]) for x in r["seq"][top - 1 :]], r["n"], r["least"], r["ends"]) for r in rows])
        out = []
        for x in nodes:
            first = x["parent"] is None
            up = (shard, above, prefix, top) if first else (None,) * 4
            out.append((
                x["least"], top - 1 + x["depth"], None if first else nodes[x["parent"]]["least"], x["n"], x["children"], x["leaves"],
                x["saved"], x["ends"], x["turn"], x["words"], *up,
            ))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:
            out = []
            for shard, rows in groupby(b.to_pylist(), lambda r: r["shard"]):
                if held and held[0]["shard"] != shard:
                    out += close(held)
                    held = []
                held += rows
            yield _batch(out, kinds)
        if held:
            yield _batch(close(held), kinds)

    return ready.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def _upper(shards: DataFrame, ended: DataFrame) -> DataFrame:
    """Nodes above all shards, with their key: sums over the shards below and the sequences that end there.

    A node's own part of a sum must count once, so it goes to one contributor below it, the least; each contributor then
    sums its path from below, and nodes add up their contributors.
    """
    below = shards.select(
        F.col("shard").alias("x"), "prefix", F.col("shard").alias("under"), F.col("n_convs").alias("n"), F.col("conv_id").alias("least"),
        F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), F.lit(None).cast("string").alias("ends"),
    )
    zero = F.lit(0).cast("bigint")
    here = ended.select(
        F.concat(F.lit(b"end"), "path").alias("x"), F.col("seq").alias("prefix"), F.lit(None).cast("binary").alias("under"), "n", "least",
        zero.alias("leaves"), zero.alias("saved"), "ends",
    )
    steps = F.transform(
        F.sequence(F.lit(0), F.size("prefix")),
        lambda j: F.struct(
            j.alias("j"), _key(F.slice("prefix", F.lit(1), j)).alias("key"), F.when(j > 0, _key(F.slice("prefix", F.lit(1), j - 1))).alias("above"),
            F.when(j < F.size("prefix"), _key(F.slice("prefix", F.lit(1), j + 1))).otherwise(F.col("under")).alias("child"),
            F.when(j > 0, F.get("prefix", j - 1)["turn"]).alias("turn"),
            F.when(j > 0, F.get("prefix", j - 1)["words"]).otherwise(0).alias("words"), F.when(j == F.size("prefix"), F.col("ends")).alias("ends"),
        ),
    )
    each = kept(below.unionByName(here).select("x", "n", "least", "leaves", "saved", F.explode(steps).alias("s")).select("x", "n", "least", "leaves", "saved", "s.*"))
    by_child = each.groupBy("key", "child").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.min("x").alias("x"), F.first("j").alias("j"), F.first("above").alias("above"),
        F.first("turn").alias("turn"), F.first("words").alias("words"), F.max("ends").alias("ends"),
    )
    nodes = cut(
        by_child.groupBy("key").agg(
            F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"), F.min("x").alias("x"), F.first("j").cast("bigint").alias("depth"),
            F.first("above").alias("above"), F.first("turn").alias("turn"), F.first("words").alias("words"), F.max("ends").alias("ends"),
            F.count("child").alias("n_children"),
        )
    )
    own = nodes.select("key", "x", ((F.col("n_convs") - 1) * F.col("words")).alias("own"), (F.col("n_children") == 0).cast("bigint").alias("leaf"))
    upward = Window.partitionBy("x").orderBy(F.col("j").desc())
    sums = (
        each.join(own, ["key", "x"], "left")
        .select(
            "key", (F.col("saved") + F.sum(F.coalesce("own", zero)).over(upward)).alias("saved"),
            (F.col("leaves") + F.sum(F.coalesce("leaf", zero)).over(upward)).alias("leaves"),
        )
        .groupBy("key")
        .agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    )
    return cut(nodes.drop("x").join(sums, "key").withColumn("ends_sha256", F.coalesce("ends", F.lit(EMPTY))).drop("ends"))


def prefix_trie(convs: DataFrame, limit: int = SHARD) -> DataFrame:
    """Nodes of the trie over sequences (conv_id, seq as from sequences()), the textless root first in depth.

    Columns: conv_id, the least member's; depth; parent_conv_id, the parent's conv_id, null for the root; n_convs, members;
    n_children; n_leaves, childless nodes in the subtree; saved_tokens, the subtree's sum of (n_convs - 1) times words;
    ends_sha256, over the ids that end there; turn and words of the node's last turn. A conversation's own sequence is one
    row, so one conversation must fit a task; equal sequences and shared prefixes need not. An empty table has no root.
    """
    paths = kept(_depths(kept(_ends(convs)), limit))
    deep = paths.where(F.size("seq") >= F.col("top")).select(
        "seq", "n", "least", "ends", F.col("top").cast("bigint").alias("top"), _key(F.slice("seq", F.lit(1), F.col("top"))).alias("shard"),
        _key(F.slice("seq", F.lit(1), F.col("top") - 1)).alias("above"),
    )
    nodes = kept(_shards(deep))
    upper = _upper(nodes.where("shard is not null"), paths.where(F.size("seq") < F.col("top")))
    columns = [c.split()[0] for c in NODE.split(", ")]
    named = upper.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("times"))
    tops = nodes.where("shard is not null").drop("parent_conv_id").unionByName(upper.where("depth > 0"), allowMissingColumns=True)
    total = named.agg(F.sum("times")).first()[0] or 0
    joined = heavy_join(tops, named, ["above"], "times", total).select(columns)
    root = upper.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(columns)
    return nodes.where("shard is null").select(columns).unionByName(joined).unionByName(root)


def with_texts(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """nodes with role and text of their last turns (null for the root), looked up in the turns that they came from."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    known = turns.select(turn_digest(role, text).alias("turn"), role.alias("role"), text.alias("text")).dropDuplicates(["turn"])
    return nodes.join(known, "turn", "left")


def op12_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(sequences(read(spark, sf_dir, "conversations")))).drop("turn", "words")


_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""
#: DuckDB SQL for the unsigned crc32 of an ASCII string.
CRC32 = "xor(" + _CRC + ", 4294967295)"

OP12_SQL = f"""
WITH turns AS (
    SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS turn,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
    FROM conversations WHERE conv_id IS NOT NULL
), seqs AS (
    SELECT conv_id, list(turn ORDER BY i) AS seq FROM turns GROUP BY conv_id
), own AS (
    SELECT conv_id, seq, {CRC32.format("conv_id::VARCHAR")} % 4 AS h FROM seqs
), rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(b.seq, [])[1:o.h], o.seq[o.h + 1:]) AS seq
    FROM own o LEFT JOIN seqs b ON b.conv_id = o.conv_id - o.conv_id % 20
), members AS (
    SELECT conv_id, len(seq) AS n_turns, d, seq[1:d] AS path FROM rebuilt, unnest(range(len(seq) + 1)) AS u(d)
), nodes AS (
    SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n_turns = d), '')) AS ends_sha256,
        CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d][2], '[^\\x20\\x09-\\x0D]+')) END AS words
    FROM members GROUP BY path, d
), family AS (
    SELECT n.path, p.conv_id AS parent_conv_id FROM nodes n JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
), children AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
    SELECT n.path[1:d] AS path, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
    FROM nodes n LEFT JOIN children c ON c.path = n.path, unnest(range(n.depth + 1)) AS u(d) GROUP BY 1
)
SELECT n.conv_id, n.depth, f.parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
    b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN family f ON f.path = n.path LEFT JOIN children c ON c.path = n.path
"""
