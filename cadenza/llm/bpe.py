"""BPE encoding and decoding with a tokenizers file, by a table of distinct words.

The file's pre-tokenizer never joins characters across white space, so a text's ids are those of its white-space words one
after the other. Documents are read in blocks; a block lists its distinct words and writes its documents as positions in
that list. The lists of all blocks meet in a table of distinct words, dealt by hash, where each word is encoded once; the ids
go back to the blocks by position and are joined with the vocabulary's pieces on id.
"""

from __future__ import annotations

import hashlib
import os
import sys
from array import array
from collections.abc import Iterator
from itertools import chain
from types import ModuleType
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import arrow_schema, in_batches, kept, read

TOKENIZER = "word_bpe_49k.json"
#: Bytes of text in a block, at most one document more.
BLOCK_BYTES = 24 << 20
MARKS = ".,;:!?"
MOST_CORES = 800_000


def tokenizer(path: str | None = None):
    """Of a tokenizers file; by default the public one of TOKENIZER."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))
    t.no_truncation()
    t.no_padding()
    return t


def split_words(text: str | None) -> list[str]:
    """Runs of anything but blank, tab and line ends; other white space stays inside and is the tokenizer's to drop."""
    flat = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ")
    return [w for w in flat.split(" ") if w]


def _byte_letters() -> dict[int, str]:
    """Byte-level pre-tokenizers write printable bytes as themselves and number the others from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class Words:
    """Ids of words as little-endian 32-bit integers, remembered within a task; of() takes all texts of a batch.

    Ids of plain lower-case words stay with the worker process from one task to the next, MOST_CORES at most.
    """

    def __init__(self, path: str | None = None, most: int = 500_000) -> None:
        self.tokenizer, self.most, self.known = tokenizer(path), most, {}
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        workers = sys.modules.setdefault("_cadenza_words", ModuleType("_cadenza_words")).__dict__
        self.cores: dict[str, bytes] = workers.setdefault(path or TOKENIZER, {})
        self.marks = {"": b""} | dict(zip(MARKS, self._ids(list(MARKS)), strict=True))

    def of(self, texts: list[str | None], together: int = 256) -> Iterator[bytes]:
        for i in range(0, len(texts), together):
            lists = [split_words(t) for t in texts[i : i + together]]
            self.learn(list(chain.from_iterable(lists)))
            for words in lists:
                yield b"".join(map(self.known.__getitem__, words))

    def learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known, new = {}, list(dict.fromkeys(words))
        if len(self.cores) > MOST_CORES:
            self.cores.clear()
        # letters and perhaps a mark after them are two pre-tokens, and case is dropped
        rest, cores = [], self.cores
        for w in new:
            mark = w[-1] if w[-1] in MARKS else ""
            core = (w[:-1] if mark else w).lower()
            ids = cores.get(core)
            if ids is None:
                if not core.isalpha() or not (core.isascii() or max(core) < "\u0100"):
                    rest.append(w)
                    continue
                spelled = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
                ids = cores[core] = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
            self.known[w] = ids + self.marks[mark]
        for i in range(0, len(rest), 8192):
            self.known.update(zip(rest[i : i + 8192], self._ids(rest[i : i + 8192]), strict=True))

    def _ids(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]


def _pack(numbers: np.ndarray) -> bytes:
    """32-bit numbers, their like bytes together, compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel() if len(raw) else np.empty(0, np.uint32)


def _blocks(batches: Iterator[dict[str, list]]) -> Iterator[tuple[int, bool, object, list[str], dict[str, int]]]:
    """(block, whether it ends here, id, words, the block's word positions so far) for each document of a task.

    Blocks are numbered by task and follow the order of its rows, so a repeated task numbers them the same.
    """
    from pyspark import TaskContext

    task, n, size, places = TaskContext.get().partitionId(), 0, 0, {}
    rows = ((i, t) for b in batches for i, t in zip(b["id"], b["text"], strict=True))
    row = next(rows, None)
    while row:
        words = split_words(row[1])
        for w in dict.fromkeys(words):
            if w not in places:
                places[w] = len(places)
        size += len(row[1] or "")
        following = next(rows, None)
        ends = size >= BLOCK_BYTES or following is None
        yield (task << 32) + n, ends, row[0], words, places
        if ends:
            n, size, places = n + 1, 0, {}
        row = following


def _by_part(places: dict[str, int], parts: int) -> list[list[str]]:
    """A block's distinct words, dealt to parts of the table by hash and sorted."""
    out: list[list[str]] = [[] for _ in range(parts)]
    for w in places:
        out[crc32(w.encode()) % parts].append(w)
    for words in out:
        words.sort()
    return out


def _list_words(parts: int):
    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for block, ends, _, _, places in _blocks(batches):
            if ends:
                lists = [(p, words) for p, words in enumerate(_by_part(places, parts)) if words]
                yield {
                    "block": [block] * len(lists),
                    "part": [p for p, _ in lists],
                    "words": [pack("\n".join(words).encode()) for _, words in lists],
                }

    return run


def _write_places(parts: int):
    """A row for each document, its words' positions in the block, and one for the block: where the table has each word."""

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        held: dict[str, list] = {k: [] for k in ("block", "order", "id", "places")}
        for block, ends, doc_id, words, places in _blocks(batches):
            rows = [(block, None, doc_id, _pack(np.fromiter(map(places.__getitem__, words), "<u4", len(words))))]
            if ends:
                listed = np.fromiter((places[w] for ws in _by_part(places, parts) for w in ws), np.int64, len(places))
                order = np.empty(len(places), np.int64)
                order[listed] = np.arange(len(places))
                rows.append((block, _pack(order), None, None))
            for row in rows:
                for k, v in zip(held, row, strict=True):
                    held[k].append(v)
            if ends or len(held["id"]) >= 512:
                yield held
                held = {k: [] for k in held}

    return run


def _encode_lists(path: str | None, schema: pa.Schema):
    """The distinct-word table, a stream of lists sorted by part: words of a part are encoded once, and each block gets its ids.

    What is known of a part is dropped with it, or when it grows beyond the bound of Words; memory does not follow the data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, at, known = zstandard.ZstdDecompressor().decompress, None, Words(path)
        for batch in batches:
            for block, part, data in zip(*(batch[c].to_pylist() for c in ("block", "part", "words")), strict=True):
                if part != at:
                    at, known.known = part, {}
                words = unpack(data).decode().split("\n")
                known.learn(words)
                got = [known.known[w] for w in words]
                counts = np.fromiter(map(len, got), np.int64, len(got)) // 4
                ids = _pack(np.concatenate([[len(got)], counts, np.frombuffer(b"".join(got), "<u4")]))
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((block, part, ids), schema, strict=True)], schema=schema)

    return run


def _assemble(pieces: list[str], schema: pa.Schema):
    """Documents of a block: the words' ids back in their places, and the vocabulary's pieces joined on id."""
    vocabulary = [p.encode() for p in pieces]
    numbers = [str(i).encode() for i in range(len(pieces))]

    def run(documents: pa.Table, words: pa.Table) -> pa.Table:
        ids: list[bytes] = []
        decoded: list[bytes] = []
        counts: list[np.ndarray] = [np.empty(0, np.int64)]
        for data in words.sort_by("part")["ids"].to_pylist():
            flat = _unpack(data)
            n = int(flat[0])
            counts.append(flat[1 : n + 1].astype(np.int64))
            stops = np.cumsum(counts[-1]).tolist()
            own = flat[n + 1 :].tolist()
            for a, b in zip([0, *stops], stops, strict=False):
                ids.append(b" ".join([numbers[i] for i in own[a:b]]))
                decoded.append(b" ".join([vocabulary[i] for i in own[a:b]]))
        size = np.concatenate(counts)
        order = next((_unpack(x) for x in documents["order"].to_pylist() if x is not None), np.empty(0, np.int64))
        out: dict[str, list] = {f.name: [] for f in schema}
        for doc_id, packed in zip(documents["id"].to_pylist(), documents["places"].to_pylist(), strict=True):
            if packed is None:
                continue
            at = order[_unpack(packed)]
            n = size[at]
            at = at[n > 0].tolist()  # a word of dropped characters has no ids
            out["doc_id"].append(doc_id)
            out["n_tokens"].append(int(n.sum()))
            out["ids_sha256"].append(hashlib.sha256(b" ".join(map(ids.__getitem__, at))).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(b" ".join(map(decoded.__getitem__, at))).hexdigest())
        return pa.Table.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run


def encode_words(words: DataFrame, path: str | None = None) -> DataFrame:
    """words (a column word, each once, and any others) with ids: array<int>, null where word is null."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = tokenizer(path)
        for words in batches:
            yield pd.Series([e.ids for e in t.encode_batch_fast(words.fillna("").tolist(), add_special_tokens=False)])

    return words.withColumn("ids", F.when(F.col("word").isNotNull(), ids("word")))


def pieces(spark, path: str | None = None) -> DataFrame:
    """(id, piece): the vocabulary, whose size is fixed by the file."""
    return spark.createDataFrame(
        [(i, p) for p, i in tokenizer(path).get_vocab(with_added_tokens=True).items()], "id int, piece string"
    )


def decode_words(words: DataFrame, path: str | None = None) -> DataFrame:
    """words (word, ids, others) with pieces: ids' pieces joined by blanks, through a join on id.

    The vocabulary is broadcast: its size is fixed by the tokenizer file.
    """
    rest = [c for c in words.columns if c != "word"]
    each = words.select("*", F.posexplode_outer("ids").alias("pos", "id"))
    named = each.join(F.broadcast(pieces(words.sparkSession, path)), "id", "left")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), " ")
    return named.groupBy("word").agg(*(F.first(c).alias(c) for c in rest), text.alias("pieces"))


def tokens_round_trip(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str | None = None, from_files: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row of docs.

    Rows are read twice and must come in the same order both times. Files do; from_files says that docs is a plain table of
    files, else it is written first.

    ids_sha256 is over the decimal ids joined by a blank, decoded_sha256 over the file's own decoding of them. Null text is
    empty: no tokens, and the hashes of nothing. A text without white space is one word. Repeated rows are encoded each.
    An empty table gives none. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = rows if from_files else kept(rows)
    spark, kind = rows.sparkSession, rows.schema["id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = in_batches(rows, _list_words(parts), "block bigint, part int, words binary")
    encoded_as = "block bigint, part int, ids binary"
    dealt = listed.repartition(parts, "part").sortWithinPartitions("part")
    encoded = dealt.mapInArrow(_encode_lists(path, arrow_schema(spark, encoded_as)), encoded_as)
    written = in_batches(rows, _write_places(parts), f"block bigint, order binary, id {kind}, places binary")
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    named = sorted(tokenizer(path).get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
    by_id = [""] * (named[-1][1] + 1)
    for piece, i in named:
        by_id[i] = piece
    return (
        written.groupBy("block")
        .cogroup(encoded.groupBy("block"))
        .applyInArrow(_assemble(by_id, arrow_schema(spark, schema)), schema)
    )


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    return tokens_round_trip(read(spark, sf_dir, "documents"), from_files=True)
