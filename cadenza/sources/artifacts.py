"""A Spark data source of per-video files: many small files to a task, and only the folders of the videos asked for.

Spark's file source lists each folder in a task of its own before it reads; here the root alone is listed, tasks list and read
their share of its folders, and a filter on video_id replaces even that listing. Spark's partitioned writers have the driver
move every folder when the job ends; here a task puts each file in its place by itself.
"""

from __future__ import annotations

import fnmatch
import os
import re
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from cadenza.operators.intervals import KEY

SCHEMA = f"{KEY} string, file string, value string, modified timestamp, bytes bigint"
#: Folders to a task: at least so many, and as many more as keep within so many tasks. Starting a task takes as long as reading
#: some thousand small files, so up to MANY to a task there are at most FEW tasks.
FOLDERS, TASKS = 32, 400
MANY, FEW = 1024, 100
#: Files that leave a task together.
BATCH_BYTES = 16 << 20
#: How files are compressed, by the end of their name, as pyarrow's streams take it.
PACKED = {".zst": "zstd", ".gz": "gzip", ".bz2": "bz2", ".lz4": "lz4"}
#: How partitioned writers call the folder of a video.
PREFIX = f"{KEY}="


def escaped(value: str) -> str:
    """As Spark writes a partition's value in a folder name."""
    return re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The filesystem of a root, and its path there."""
    local = re.sub(r"^file:/+", "/", root)
    if not re.match(r"\w+:/", local):
        return fs.LocalFileSystem(), os.path.abspath(local)
    files, base = fs.FileSystem.from_uri(root)
    return files, base.rstrip("/")


def unpacked(name: str, raw: bytes) -> bytes:
    """What a file holds; of one that is compressed, by its name, and torn, nothing."""
    kind = PACKED.get(os.path.splitext(name)[1])
    if kind is None:
        return raw
    try:
        return pa.CompressedInputStream(pa.BufferReader(raw), kind).read()
    except OSError:
        return b""


class Folders(InputPartition):
    def __init__(self, names: list[str]):
        self.names = names


class ArtifactReader(DataSourceReader):
    """Files root/<video>/<name>; a file that goes away before it is read gives no row."""

    def __init__(self, options: dict):
        self.root, self.name = options["path"], options.get("name", "*")
        self.contents = str(options.get("contents", "true")).lower() == "true"
        self.only: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == (KEY,):
                asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = asked if self.only is None else self.only & asked
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        if self.only is not None:
            names = sorted({v for v in self.only if v and "/" not in v and v.strip(".")} | {PREFIX + escaped(v) for v in self.only if v})
        else:
            files, base = opened(self.root)
            found = files.get_file_info(fs.FileSelector(base, allow_not_found=True))
            names = sorted(i.base_name for i in found if i.type == fs.FileType.Directory)
        each = max(FOLDERS, min(MANY, -(-len(names) // FEW)), -(-len(names) // TASKS))
        return [Folders(names[at : at + each]) for at in range(0, len(names), each)] or [Folders([])]

    def _found(self, names: list[str]) -> Iterator[tuple]:
        files, base = opened(self.root)
        one = not re.search(r"[*?\[]", self.name)  # a plain name is looked up, no folder is listed
        for folder in names:
            video = unquote(folder.removeprefix(PREFIX)) if folder.startswith(PREFIX) else folder
            at = f"{base}/{folder}"
            for i in files.get_file_info([f"{at}/{self.name}"] if one else fs.FileSelector(at, allow_not_found=True)):
                if i.type != fs.FileType.File or i.base_name[0] in "._" or not fnmatch.fnmatchcase(i.base_name, self.name):
                    continue
                text = None
                if self.contents:
                    try:
                        with files.open_input_stream(i.path, compression=None) as stream:
                            text = unpacked(i.base_name, stream.read()).decode("utf-8-sig", "replace")
                    except FileNotFoundError:
                        continue
                yield video, i.base_name, text, i.mtime, i.size

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.string(), pa.string(), pa.timestamp("us", "UTC"), pa.int64())
        names = (KEY, "file", "value", "modified", "bytes")

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        held: list[tuple] = []
        size = 0
        for row in self._found(partition.names):
            held.append(row)
            size += len(row[2]) if self.contents else 64
            if size >= BATCH_BYTES:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)


class ArtifactWriter(DataSourceArrowWriter):
    """Files root/video_id=<video>/<name>, one for each row; a file that is there is replaced. A name in .zst or .gz is compressed so.

    A file appears whole under its name, so a task that runs again does no harm. Files of a job that fails stay.
    """

    def __init__(self, options: dict):
        self.root, self.name = options["path"], options["name"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, base = opened(self.root)
        hidden = f".{uuid.uuid4()}.{self.name}"  # its end tells how it is compressed
        for batch in iterator:
            for video, text in zip(batch.column(KEY).to_pylist(), batch.column("value").to_pylist(), strict=True):
                folder = f"{base}/{PREFIX}{escaped(video)}"
                files.create_dir(folder)
                with files.open_output_stream(f"{folder}/{hidden}") as stream:
                    stream.write(text.encode("utf-8"))
                files.move(f"{folder}/{hidden}", f"{folder}/{self.name}")
        return WriterCommitMessage()


class ArtifactSource(DataSource):
    """Options: path, the root; name, a file name or pattern; contents, false for names and sizes alone."""

    @classmethod
    def name(cls) -> str:
        return "artifacts"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArtifactReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ArtifactWriter(dict(self.options))


def artifacts(spark: SparkSession, root: str, name: str = "*", contents: bool = True) -> DataFrame:
    """video_id, file, value (its text), modified and bytes of root/*/name, a name or a pattern of * and ?. Names that begin with . or _ are no artifacts.

    The filesystem of root is one that pyarrow opens. Turns on filter push-down to Python sources in the session.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArtifactSource)
    return spark.read.format("artifacts").option("name", name).option("contents", str(contents).lower()).load(root)


def write_artifacts(rows: DataFrame, root: str, name: str, dealt: bool = False) -> None:
    """A file root/video_id=<video>/<name> for each row (video_id, value), as many tasks at a time as shuffles have; other files stay.

    Rows of one video must not be two. Rows that are dealt to enough tasks are not shuffled. The filesystem of root is one that
    pyarrow opens.
    """
    spark = rows.sparkSession
    spark.dataSource.register(ArtifactSource)
    each = rows.select(F.col(KEY).cast("string").alias(KEY), F.coalesce("value", F.lit("")).alias("value"))
    if not dealt:
        each = each.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), KEY)  # a number given, so that small rows do not end up in one task
    each.write.format("artifacts").mode("append").option("name", name).save(root)


def typed_rows(files: DataFrame, schema: str) -> DataFrame:
    """A row for each entry of each file's list (an object: one), with its place seq, the fields of schema, _rejects and _corrupt.

    A file that is no whole JSON is one row, its text in _corrupt; an empty list has none. A field that cannot be read as its
    type is null and named in _rejects, in the order of schema; absent ones and JSON nulls are null alone. An entry that is no
    object names all fields. Fields of type variant hold whatever is there.
    """
    whole = F.try_parse_json("value")
    is_list = F.startswith(F.ltrim("value"), F.lit("["))
    listed = files.withColumn("__v", whole).withColumn(
        "__w", F.when(is_list, F.try_variant_get("__v", "$", "array<variant>")).when(F.col("__v").isNotNull(), F.array("__v"))
    )
    torn = F.when(F.col("__w").isNull(), F.coalesce("value", F.lit("")))
    kept = [c for c in files.columns if c != "value"]
    each = listed.select(*kept, torn.alias("_corrupt"), F.posexplode_outer("__w").alias("seq", "__e"))
    each = each.where("__e is not null or _corrupt is not null")
    fields = [tuple(f.strip().split(None, 1)) for f in schema.split(",")]
    apart = each.select("*", *(F.try_variant_get("__e", f"$.{name}", "variant").alias(f"__{name}") for name, _ in fields))
    typed = apart.select("*", *(F.try_variant_get(f"__{name}", "$", type_).alias(name) for name, type_ in fields))
    no_object = F.coalesce(*(F.col(f"__{name}") for name, _ in fields)).isNull() & ~F.startswith(F.schema_of_variant("__e"), F.lit("OBJECT"))
    refused = [F.when(F.col(n).isNull() & F.col(f"__{n}").isNotNull() & ~F.is_variant_null(f"__{n}"), F.lit(n)) for n, _ in fields]
    names = F.when(no_object, F.array(*(F.lit(n) for n, _ in fields))).otherwise(F.array_compact(F.array(*refused)))
    return typed.select(
        *kept, F.col("seq").cast("bigint").alias("seq"), *(n for n, _ in fields), F.when(F.col("__e").isNotNull(), names).alias("_rejects"), "_corrupt"
    )
