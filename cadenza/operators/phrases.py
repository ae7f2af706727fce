"""Replacing phrases of a table of any size in texts: joins on first words and on whole phrases, the leftmost longest kept."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.grouping import fold
from cadenza.operators.intervals import KEY

#: A text is runs of these and runs of all else in turn; phrases begin and end with whole runs.
WORD = "[A-Za-z0-9]"
RUNS = rf"{WORD}+|[^A-Za-z0-9]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _runs(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(RUNS), F.lit(0))


def _same(c: Column) -> Column:
    """Without case of A-Z and of one kind of apostrophe, place by place."""
    return F.translate(c, UPPER + "’", UPPER.lower() + "'")


def phrase_table(phrases: DataFrame) -> DataFrame:
    """(gram, spoken, first, size) of phrases (phrase, spoken); one that does not begin and end with A-Z, a-z or 0-9 is left out.

    Phrases equal but for case and apostrophes are one, said as the least of them; a null spoken is empty.
    """
    t = phrases.select(_same(F.col("phrase")).alias("gram"), F.coalesce("spoken", F.lit("")).alias("spoken"))
    t = t.where(F.col("gram").rlike(rf"^{WORD}") & F.col("gram").rlike(rf"{WORD}\z")).groupBy("gram").agg(F.min("spoken").alias("spoken"))
    runs = _runs(F.col("gram"))
    return t.select("gram", "spoken", runs[0].alias("first"), F.size(runs).alias("size"))


def find_phrases(df: DataFrame, text: str, phrases: DataFrame, keys: tuple[str, ...] = (KEY, "id")) -> DataFrame:
    """(keys, p, e, spoken): runs p to e - 1 of a text, from 0, that are a phrase. Of those that overlap the leftmost, then longest.

    A phrase is no part of a longer word nor followed by an apostrophe and more letters, but for 's, which goes with it. Words
    of the texts meet the phrases' first words, then only places so found are cut out and joined with whole phrases; Spark
    broadcasts either table where it is small and else shuffles. keys identify a row.
    """
    known = phrase_table(phrases)
    starts = known.groupBy("first").agg(F.collect_set("size").alias("sizes"))
    texts = df.select(*keys, _same(F.coalesce(F.col(text), F.lit(""))).alias("__t"))
    each = texts.select(*keys, F.posexplode(_runs(F.col("__t"))).alias("p", "first")).where(F.col("first").rlike(f"^{WORD}"))
    places = each.join(starts, "first").groupBy(*keys).agg(F.collect_list(F.struct("p", "sizes")).alias("__at"))
    held = texts.join(places, list(keys)).withColumn("__r", _runs(F.col("__t")))

    def cut_out(x: Column) -> Column:
        return F.transform(
            x["sizes"], lambda n: F.struct(
                x["p"].alias("p"), n.alias("size"), F.array_join(F.slice("__r", x["p"] + 1, n), "").alias("gram"), F.slice("__r", x["p"] + 1 + n, 4).alias("after"),
            ),
        )

    found = held.select(*keys, F.explode(F.flatten(F.transform("__at", cut_out))).alias("c")).select(*keys, "c.*")
    after, stop = F.col("after"), F.col("p") + F.col("size")
    tail = lambda i, least: F.coalesce((F.get(after, F.lit(i)) == "'") & (F.size(after) >= least), F.lit(False))
    own = tail(0, 2) & (F.get(after, F.lit(1)) == "s") & ~tail(2, 4)
    found = found.withColumn("e", F.when(own, stop + 2).when(~tail(0, 2), stop)).where("e is not null")
    matches = found.join(known.select("gram", "spoken"), "gram").select(*keys, "p", "size", "e", "spoken")
    w = Window.partitionBy(*keys).orderBy("p", F.desc("size"))
    reach = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    apart = matches.withColumn("__n", F.row_number().over(w)).withColumn("__new", F.when(F.coalesce(F.col("p") >= reach, F.lit(True)), 1).otherwise(0))
    apart = apart.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    columns = apart.columns
    at = [columns.index(c) for c in ("p", "e", "spoken")]

    def step(rows: list) -> Iterable[tuple]:
        end = -1
        for r in rows:
            p, e, spoken = (r[i] for i in at)
            if p >= end:
                end = e
                yield p, e, spoken

    return fold(apart, [*keys, "__island"], "__n", step, "p int, e int, spoken string").drop("__island")


def replace_phrases(df: DataFrame, text: str, phrases: DataFrame, out: str = "replaced", keys: tuple[str, ...] = (KEY, "id")) -> DataFrame:
    """df with out: its text with the phrases that find_phrases finds said otherwise; a null text is empty."""
    found = find_phrases(df, text, phrases, keys)
    kept = found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("p", "e", "spoken"))).alias("__k"))
    j = df.join(kept, list(keys), "left").withColumn("__r", _runs(F.coalesce(F.col(text), F.lit(""))))
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("__k", i - 1)["e"])
    pieces = F.transform("__k", lambda m, i: F.concat(F.array_join(F.slice("__r", before(i) + 1, m["p"] - before(i)), ""), m["spoken"]))
    rest = F.array_join(F.slice("__r", F.get("__k", F.size("__k") - 1)["e"] + 1, F.size("__r")), "")
    said = F.when(F.col("__k").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return j.withColumn(out, said).drop("__k", "__r")
