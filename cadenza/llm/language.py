"""Language identification by compression: the language whose zstandard dictionary makes a text smallest."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import in_batches, read

#: Raw content of a dictionary, in bytes, of passages of PASSAGE characters from a hash sample of each language's texts.
DICTIONARY = 96 << 10
PASSAGE = 1500
#: Texts are compressed in parts of so many bytes, so that a long one cannot lean on its own beginning.
PART = 2048
LEVEL = 6
#: Dictionaries held ready in a task; with more languages they are made for so many at a time, anew for each batch.
HELD = 64
#: A best size less than this share below the second is a narrow margin: rejected.
MARGIN = 0.01


_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower case, each run of anything but letters as one blank: case, digits and symbols tell no language."""
    return _OTHER.sub(" ", text.lower())


def learn(docs: DataFrame, where: Column) -> dict[str, bytes]:
    """Dictionary content per language from rows of docs (doc_id, text, lang) where the condition and lang hold."""
    known = docs.select("doc_id", "text", "lang").where(where & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    wanted = 2 * DICTIONARY // PASSAGE
    of = 1 << 30
    share = (of * F.least(F.lit(1.0), wanted / F.col("n"))).cast("bigint")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(of))
    start = F.lit(1) + F.pmod(F.xxhash64("text", "doc_id"), F.greatest(F.length("text") - PASSAGE, F.lit(1)))
    some = known.join(F.broadcast(counts), "lang").where(draw < share).select(
        "lang", draw.alias("draw"), F.substring("text", start.cast("int"), F.lit(PASSAGE)).alias("part")
    )
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "part"))
    parts: dict[str, list[tuple[int, str]]] = {}
    for r in some.withColumn("__n", first).where(F.col("__n") <= 4 * wanted).collect():
        parts.setdefault(r["lang"], []).append((r["draw"], r["part"]))
    return {k: "\n".join(letters(p) for _, p in sorted(v)).encode()[:DICTIONARY] for k, v in sorted(parts.items())}


def _compressors(contents: list[bytes]) -> list:
    import zstandard as z

    out = []
    for raw in contents:
        d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False).compress)
    return out


class Classifier:
    def __init__(self, content: dict[str, bytes]) -> None:
        self.languages, raw = list(content), list(content.values())
        self.groups = [raw[i : i + HELD] for i in range(0, len(raw), HELD)]
        self.ready = [_compressors(g) for g in self.groups[:1]] if len(self.groups) == 1 else None

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Of each text language, score and whether the margin was too narrow; und without a letter."""
        if self.ready:
            return [self._best(self._sizes([t], self.ready[0])[0]) for t in texts]
        sizes: list[list[int]] = [[] for _ in texts]
        for group in self.groups:
            for all_, more in zip(sizes, self._sizes(texts, _compressors(group)), strict=True):
                all_ += more
        return [self._best(s) for s in sizes]

    def _sizes(self, texts: list[str | None], compress: list) -> list[list[int]]:
        """Of each text its bytes by every compressor; none without a letter."""
        out = []
        for text in texts:
            raw = letters(text).encode() if text and any(map(str.isalpha, text)) else b""
            parts = [raw[i : i + PART] for i in range(0, len(raw), PART)]
            out.append([sum(len(c(p)) for p in parts) for c in compress] if raw else [])
        return out

    def _best(self, sizes: list[int]) -> tuple[str, float, bool]:
        if not sizes:
            return "und", 0.0, True
        best = min(sizes)
        score = 1 / sum(math.exp(-min(s - best, 500) * math.log(2)) for s in sizes)
        second = sorted(sizes)[1] if len(sizes) > 1 else math.inf
        return self.languages[sizes.index(best)], score, second - best < MARGIN * second


def identify(docs: DataFrame, content: dict[str, bytes], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of docs.

    lang_pred is the learned language whose dictionary gives the fewest bytes over the letters of the whole text (of equal ones the first
    in order), score 1 over the sum of 2 to the power of minus every size's bytes beyond the best. rejected marks a narrow
    margin. Texts that are null or hold no letter are und, with score 0 and rejected; so are all if nothing was
    learned. Repeated rows are judged each. An empty table gives none. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        judge = Classifier(content)
        for b in batches:
            found = judge(b["text"])
            yield {"doc_id": b["doc_id"]} | {
                k: [f[i] for f in found] for i, k in enumerate(("lang_pred", "score", "rejected"))
            }

    return in_batches(rows, work, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = identify(docs, learn(docs, ~held_out))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
