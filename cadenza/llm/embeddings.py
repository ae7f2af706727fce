"""Embedding near-duplicates: int8 quantised tile products with an error bound for each vector.

A vector x of length 1 is stored as q / s with whole q of at most 127; its error |x - q/s| is measured. The product of
two stored vectors differs from the true cosine by no more than the errors allow, so a pair is decided by its int8
product unless the threshold lies within that bound; only those pairs are computed again in double precision. The first
pass ships a byte for each component; the second one ships double vectors, but only those of undecided pairs, cell by cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import arrow_schema, cut, kept, read
from cadenza.llm.graph import components

COSINE = 0.9
#: Vectors in a block; a task multiplies two blocks. Each vector is sent to as many tasks as there are blocks.
BLOCK = 4096
#: Rows and columns of a product held at once.
TILE = 1024
#: Components of an exact product in single precision.
EXACT = 1024
#: Room for rounding in single and double precision beyond the quantisation error.
SLACK = 1e-6


def _usable(v: Column) -> Column:
    """Not null or empty, finite throughout, and not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by their largest component first, else squares of very small or large ones are lost."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 q, 1/s and the error of each row of unit length."""
    step = np.abs(x).max(axis=1) / 127
    q = np.rint(x / step[:, None])
    return q.astype(np.int8), step, np.linalg.norm(x - q * step[:, None], axis=1)


def _products(qa: np.ndarray, qb: np.ndarray) -> np.ndarray:
    """Of int8 rows, exact: sums of EXACT squares of at most 127 stay below 2^24, where single precision has all whole numbers."""
    parts = [
        qa[:, k : k + EXACT].astype(np.float32) @ qb[:, k : k + EXACT].astype(np.float32).T
        for k in range(0, max(1, qa.shape[1]), EXACT)
    ]
    return parts[0] if len(parts) == 1 else np.sum(parts, axis=0, dtype=np.float64)


def tile_links(a: tuple, b: tuple, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a and of b, both quantised, whose cosine is surely threshold or more, or may be, and which of the pairs is sure;
    same: a is b, each pair once."""
    (qa, sa, ea), (qb, sb, eb) = a, b
    found = []
    for i in range(0, len(qa), TILE):
        for j in range(i if same else 0, len(qb), TILE):
            ra, rb = slice(i, i + TILE), slice(j, j + TILE)
            product = _products(qa[ra], qb[rb])
            product *= sa[ra, None].astype(product.dtype)
            product *= sb[None, rb].astype(product.dtype)
            # |x.y - x'.y'| <= |x||y-y'| + |y||x-x'| + |x-x'||y-y'| for unit x, y
            worst = ea[ra].max() + eb[rb].max() + ea[ra].max() * eb[rb].max() + SLACK
            x, y = np.nonzero(product >= threshold - worst)
            value = product[x, y].astype(np.float64)
            x, y = x + i, y + j
            if same:
                once = x < y
                x, y, value = x[once], y[once], value[once]
            bound = ea[x] + eb[y] + ea[x] * eb[y] + SLACK
            open_ = value + bound >= threshold
            found.append((x[open_], y[open_], (value - bound >= threshold)[open_]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position that each of n positions can reach over the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _stored(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """id, copies and v as id, copies, width, and the quantised vector."""
    for batch in batches:
        rows = []
        for i, n, v in zip(*(batch[c].to_pylist() for c in ("id", "copies", "v")), strict=True):
            q, step, error = quantise(unit(np.asarray([v], np.float64)))
            rows.append((i, n, len(v), q.tobytes(), float(step[0]), float(error[0])))
        columns = list(zip(*rows, strict=True)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _linked(ids: np.ndarray, copies: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the number of links and the smallest id reached within the cell; ids are sorted."""
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    return links, ids[_roots(len(ids), a, b)]


def _cell(threshold: float, schema: pa.Schema):
    """Sure links between the two blocks of a cell, and which vectors take part in pairs that are not decided."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        ids, copies, second, step, error = (table[c].to_numpy() for c in ("id", "copies", "second", "step", "error"))
        q = np.frombuffer(b"".join(table["q"].to_pylist()), np.int8).reshape(len(ids), -1)
        same = bool(table["same"][0].as_py())
        left = np.nonzero(second == 0)[0]
        right = left if same else np.nonzero(second == 1)[0]
        a = b = np.empty(0, np.int64)
        sure, undecided = np.empty(0, bool), np.zeros(len(ids), bool)
        if len(left) and len(right):
            a, b, sure = tile_links(*((q[r], step[r], error[r]) for r in (left, right)), same, threshold)
            a, b = left[a], right[b]
            undecided[a[~sure]] = undecided[b[~sure]] = True
        links, root = _linked(ids, copies, a[sure], b[sure])
        hit = (links > 0) | undecided
        cell = table.select(["width", "i", "j", "second", "same"]).filter(pa.array(hit))
        out = [pa.array(x[hit]) for x in (ids, copies, links, root, undecided)]
        return pa.Table.from_arrays([*out, *(c.combine_chunks() for c in cell.columns)], schema=schema)

    return run


def _recheck(threshold: float, schema: pa.Schema):
    """Links among the undecided pairs of a cell, in double precision."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        ids, copies, second = (table[c].to_numpy() for c in ("id", "copies", "second"))
        flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = unit(flat.reshape(len(ids), -1).astype(np.float64))
        same = bool(table["same"][0].as_py())
        left = np.nonzero(second == 0)[0]
        right = left if same else np.nonzero(second == 1)[0]
        a, b, sure = tile_links(*(quantise(vectors[r]) for r in (left, right)), same, threshold)
        a, b = left[a[~sure]], right[b[~sure]]
        near = np.zeros(len(a), bool)
        for k in range(0, len(a), 65536):
            part = slice(k, k + 65536)
            near[part] = np.einsum("ij,ij->i", vectors[a[part]], vectors[b[part]]) >= threshold
        links, root = _linked(ids, copies, a[near], b[near])
        hit = links > 0
        return pa.Table.from_arrays([pa.array(x[hit], pa.int64()) for x in (ids, links, root)], schema=schema)

    return run


def near_vectors(vectors: DataFrame, threshold: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors; needs vec_id and embedding.

    n_links is the number of other rows whose cosine with this one is threshold or more; component_id the smallest id
    reachable over links. Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
    nor do vectors of different lengths with each other. Equal vectors form one class with a count before any product
    is made. Rows that repeat an id count as vectors. A row without an id links with nothing and is kept. An empty
    table gives none. Other columns are ignored.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("v"),
    ).withColumn("v", F.when(_usable(F.col("v")) & F.col("vec_id").isNotNull(), F.col("v")))
    usable = rows.where("v is not null")
    classes = cut(usable.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    n_blocks = max(1, -(-classes.count() // block))
    stored_as = "id bigint, copies bigint, width int, q binary, step double, error double"
    stored = arrow_schema(rows.sparkSession, stored_as)
    own = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    sent = classes.mapInArrow(lambda batches: _stored(batches, stored), stored_as).select("*", own.alias("own"), other.alias("other"))
    sent = sent.select(
        "id", "copies", "width", "q", "step", "error",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("second"), (F.col("own") == F.col("other")).alias("same"),
    )
    cell = "id bigint, copies bigint, links bigint, root bigint, undecided boolean, width int, i int, j int, second int, same boolean"
    cells = sent.groupBy("width", "i", "j").applyInArrow(_cell(threshold, arrow_schema(rows.sparkSession, cell)), cell)
    first = kept(cells)
    again = first.where("undecided").join(classes.select("id", "v"), "id")
    schema = "id bigint, links bigint, root bigint"
    second = again.groupBy("width", "i", "j").applyInArrow(_recheck(threshold, arrow_schema(rows.sparkSession, schema)), schema)
    found = cut(first.where("links > 0").select("id", "links", "root").unionByName(second))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (
        classes.join(links, "id", "left")
        .join(joined, F.col("id") == F.col("node"), "left")
        .select("v", "copies", "links", F.coalesce("component", "id").alias("component"))
    )
    linked = usable.join(named, "v").select(
        "vec_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.col("component").alias("component_id"),
    )
    alone = rows.where("v is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), comp AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS k FROM links GROUP BY a)
SELECT vec_id, coalesce(k, 0) AS n_links, component AS component_id, vec_id = component AS kept
FROM embeddings LEFT JOIN n ON a = vec_id JOIN comp ON node = vec_id
"""
