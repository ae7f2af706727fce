"""Helpers shared by the training-data operators: cutting lineage, reading tables, and batches for Python tasks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The words of the contracts: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one that is set, else that of spark.checkpoint.dir, which all machines must reach.

    Only where all runs in one process, as in tests, a temporary folder may take its place; on a cluster it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and context.master.startswith("local"):
            named = tempfile.mkdtemp(prefix="cadenza-")
        if not named:
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there."""
    _shared_folder(df.sparkSession)
    return df.checkpoint()


def kept(df: DataFrame) -> DataFrame:
    """Like cut, as Parquet in a folder of its own under the checkpoint folder: for larger tables, read by column."""
    path = f"{_shared_folder(df.sparkSession)}/{uuid.uuid4()}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a cut table to a task that reads it again.
ROWS = 1 << 17


def packed(df: DataFrame, rows: int) -> DataFrame:
    """df, cut before, of that many rows at most, in no more partitions than hold ROWS each, but two: the driver keeps a record
    of each task, and a small table otherwise has as many as the shuffle before it. Of one partition alone all that follows would
    be a single stage, whose tasks hold the memory of all its operators at once."""
    return df.coalesce(max(2, -(-rows // ROWS)))


#: Keys with more than one in so many of all rows are heavy: fewer than this many can be.
HEAVY = 2000


def heavy_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    times: str,
    total: int,
    rest: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    hot: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Inner join of rows with a lookup table, unique by keys, whose column times counts the rows of a key, of total in all.

    Heavy keys are joined where their rows stand: their share of the lookup, fewer than HEAVY rows, is broadcast. The other
    keys are joined by a shuffle, in which no key has more than one row in HEAVY. rest and hot put something else in place of
    the join of light rows with the light lookup and behind that of heavy ones.
    """
    bar = total / HEAVY
    heavy = lookup.where(F.col(times) > bar)
    light = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    join = rest or (lambda some, table: some.join(table, keys))
    return hot(rows.join(F.broadcast(heavy), keys)).unionByName(
        join(light, lookup.where(F.col(times) <= bar)), allowMissingColumns=True
    )


def row_key(*columns: str, text: str = "text") -> Column:
    """A struct, never null, of columns and the text's digest: equal for rows that agree in them, null agreeing with null."""
    return F.struct(*columns, F.md5(F.col(text).cast("binary")).alias("digest"))


def whole_row(docs: DataFrame) -> Column:
    """All columns of docs as one struct, so that no name of theirs can clash with a new one; select("row.*") gives them back."""
    return F.struct(*(docs["`" + c.replace("`", "``") + "`"] for c in docs.columns)).alias("row")


def row_digest(docs: DataFrame) -> Column:
    """64 bits of all columns, of which maps count as they are written."""
    parts = []
    for field in docs.schema.fields:
        c = docs["`" + field.name.replace("`", "``") + "`"]
        parts.append(F.to_json(F.struct(c.alias("m"))) if "map<" in field.dataType.simpleString() else c)
    return F.xxhash64(*parts)


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_batches(
    df: DataFrame, work: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]], schema: str
) -> DataFrame:
    """mapInArrow over columns as Python lists: work takes and yields dicts of lists, one per Arrow batch."""
    kinds = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(b.to_pydict() for b in batches if b.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in kinds], schema=kinds)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema))
