"""Quality rules: text statistics and robust multivariate outliers, in DataFrame functions only.

Each text gets a vector of transformed statistics. Per language and source, concentration steps from several starts run until
they are stable, and the centre and covariance of least determinant stand; then they lean on those of the whole language, the
more the fewer texts a group has. A text whose Mahalanobis distance from its group's centre is too large is rejected.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import SPACE, WORD, cut, heavy_join, packed, read, row_key, whole_row

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
#: Statistics are whole multiples of 1/UNIT, so that sums are exact whatever the order of rows.
UNIT = 1024
#: The vector, and for each part the standard deviation below which a spread is not believed. Most texts have no
#: symbols or repeated lines, so without a least spread the tightest part of them would have none of either and no covariance.
FEATURES = {"x_length": 0.5, "x_word": 0.6, "x_symbol": 0.35, "x_line": 0.8, "x_repeat": 0.9}
#: Part of a group that the estimates rest on.
CORE = 0.75
#: Starts of the concentration steps besides quartiles and all texts: so many samples by hash, one text in SAMPLE each.
SAMPLES, SAMPLE = 2, 8
#: Steps from every start; steps from the best one, which end when logarithms of determinants fall by no more than FALLS.
FEW, FALLS = 2, 0.01
#: The language's estimate counts as so many texts beside a group's own.
LEAN = 60
#: Rejected are texts whose distance a normal vector exceeds with this probability. The statistics have heavier tails than
#: normal ones, so the rule leaves room for them and speaks only of texts far outside their group.
TAIL = 1e-16
#: Parameters of up to so many groups (about 300 bytes for each start) are broadcast whole; of more, only those of heavy groups.
BROADCAST_GROUPS = 4096
#: Distances are counted in bins of this many to a unit of their logarithm, BINS at most.
BINS_PER_LOG, BINS = 64, 2000


def chi2_tail(x: float) -> float:
    """Probability that chi-squared with five degrees of freedom, one for each part of the vector, exceeds x."""
    return math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)


def chi2_quantile(tail: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_tail(middle) > tail else (low, middle)
    return high


CHI2_MEDIAN, CUTOFF = chi2_quantile(0.5), chi2_quantile(TAIL)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs' columns and __stats: struct<n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines> (bigint).

    Null text counts as empty: all zero. A repeated word stands in a three-word window that the text holds twice or more;
    windows are compared by their 64-bit hashes, within one text. Everything stays in the row: no shuffle.
    """
    whole = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    words = whole.withColumn("__words", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)))
    n = F.size("__words")
    starts = F.slice("__words", F.lit(1), F.greatest(n - 2, F.lit(0)))
    windows = words.withColumn(
        "__windows",
        F.sort_array(
            F.transform(
                starts,
                lambda w, i: F.struct(
                    F.xxhash64(w, F.get("__words", i + 1), F.get("__words", i + 2)).alias("h"), i.alias("i")
                ),
            )
        ),
    )

    def same(e: Column, k: Column) -> Column:
        return F.coalesce(F.get("__windows", k)["h"] == e["h"], F.lit(False))

    again = windows.withColumn(
        "__again",
        F.sort_array(
            F.transform(F.filter("__windows", lambda e, k: same(e, k - 1) | same(e, k + 1)), lambda e: e["i"])
        ),
    )
    covered = F.aggregate(
        "__again",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("total")),
        lambda acc, i: F.struct(i.alias("last"), (acc["total"] + F.least(F.lit(3), i - acc["last"])).alias("total")),
        lambda acc: acc["total"],
    )
    lines = again.withColumn(
        "__lines", F.filter(F.split("__text", "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    )
    stats = F.struct(
        n.cast("bigint").alias("n_words"),
        (F.char_length("__text") - F.regexp_count("__text", F.lit(SPACE))).cast("bigint").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("__lines").cast("bigint").alias("n_lines"),
    )
    return lines.withColumn("__stats", stats).drop("__text", "__words", "__windows", "__again", "__lines")


def _vector() -> dict[str, Column]:
    """Logarithms of length, mean word length, and shares of symbols, repeated lines and repeated words, in units."""
    c = F.col
    per_word = F.greatest(c("n_words"), F.lit(1)).cast("double")
    parts = {
        "x_length": F.log(per_word),
        "x_word": c("word_chars") / per_word,
        "x_symbol": F.log1p(20 * c("n_symbols") / per_word),
        "x_line": F.log1p(20 * c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)).cast("double")),
        "x_repeat": F.log1p(20 * c("n_repeat_words") / per_word),
    }
    return {k: F.round(UNIT * v).cast("bigint") for k, v in parts.items()}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def _joined(rows: DataFrame, groups: DataFrame, key: str, n_groups: int, total: int) -> DataFrame:
    """rows with the parameters of their group, once for each of its starts; groups has the size of each in of."""
    if n_groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), key)
    return heavy_join(rows, groups, [key], "of", total)


def _quartiles(rows: DataFrame, key: str) -> DataFrame:
    """Medians and interquartile ranges of each part per group, from counts of bins a sixteenth wide, as mean and diagonal."""
    width = UNIT // 16
    parts = F.array(*(F.struct(F.lit(k).alias("k"), F.floor(F.col(k) / width).alias("bin")) for k in FEATURES))
    counts = rows.select(key, F.explode(parts).alias("p")).groupBy(key, "p.k", "p.bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy(key, "k")
    ranked = counts.withColumn("total", F.sum("n").over(w)).withColumn(
        "upto", F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    )

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bin"))) * width + width / 2

    by_part = ranked.groupBy(key, "k").agg(
        F.first("total").alias("of"),
        quantile(0.5).alias("m"),
        ((quantile(0.75) - quantile(0.25)) / 1.349).alias("s"),
    )
    each = [
        F.max(F.when(F.col("k") == k, v)).alias(name)
        for i, (k, least) in enumerate(FEATURES.items())
        for v, name in ((F.col("m"), f"m{i}"), (F.greatest("s", F.lit(least * UNIT)), f"l{i}{i}"))
    ]
    rest = [F.lit(0.0).alias(f"l{i}{j}") for i, j in _pairs() if i != j]
    found = by_part.groupBy(key).agg(F.first("of").alias("of"), *each)
    return found.select("*", *rest, F.lit("quartiles").alias("start"), F.lit(math.inf).alias("volume"))


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Numbers of rows, sums and sums of products of the vector's parts: exact whatever the order of rows."""
    names = list(FEATURES)
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *(F.expr(f"sum(cast({k} AS decimal(19,0))) AS s{i}") for i, k in enumerate(names)),
        *(F.expr(f"sum(cast({names[i]} * {names[j]} AS decimal(19,0))) AS q{i}{j}") for i, j in _pairs()),
    )


def _cholesky(names: dict[tuple[int, int], str]) -> list[str]:
    """The factor l of a covariance whose parts are named, and volume, the logarithm of its determinant: a row at a time, each
    expression naming those before it."""
    out = []
    for i, j in _pairs():
        v = " - ".join([names[i, j], *(f"l{i}{k} * l{j}{k}" for k in range(j))])
        out.append(f"sqrt(greatest({v}, 1.0D)) AS l{i}{j}" if i == j else f"({v}) / l{j}{j} AS l{i}{j}")
    out.append("2 * (" + " + ".join(f"ln(l{i}{i})" for i in range(len(FEATURES))) + ") AS volume")
    return out


def _parameters() -> list[str]:
    return [*(f"m{i}" for i in range(len(FEATURES))), *(f"l{i}{j}" for i, j in _pairs()), "volume"]


def _estimate(sums: DataFrame, *keep: str) -> DataFrame:
    """keep, mean m, Cholesky factor l of the covariance and volume, the logarithm of its determinant."""
    least = list(FEATURES.values())
    out = [*keep, *(f"cast(s{i} AS double) / n AS m{i}" for i in range(len(FEATURES)))]
    for i, j in _pairs():
        v = f"cast(q{i}{j} AS double) / n - m{i} * m{j}"
        out.append(f"{f'greatest({v}, {(least[i] * UNIT) ** 2}D)' if i == j else v} AS __v{i}{j}")
    out += _cholesky({(i, j): f"__v{i}{j}" for i, j in _pairs()})
    return sums.selectExpr(*out).select(*keep, *_parameters())


def _starts(rows: DataFrame, key: str) -> DataFrame:
    """Quartiles, all texts, and samples by the hash of the vector, of each group; a sample without texts is left out."""
    draw = F.pmod(F.xxhash64(*FEATURES), F.lit(SAMPLE))
    chosen = F.explode(F.array(F.lit("all"), *(F.when(draw == k, F.lit(f"sample {k}")) for k in range(SAMPLES))))
    sums = _sums(rows.withColumn("start", chosen).where("start is not null"), key, "start")
    both = _quartiles(rows, key).unionByName(_estimate(sums, key, "start"), allowMissingColumns=True)
    return both.withColumn("of", F.max("of").over(Window.partitionBy(key)))


def _with_distance(rows: DataFrame) -> DataFrame:
    """rows and d2, the squared distance of the vector from the group's mean, by forward substitution in the factor l."""
    ys = []
    for i, k in enumerate(FEATURES):
        rest = " - ".join([f"{k} - m{i}", *(f"l{i}{j} * __y{j}" for j in range(i))])
        ys.append(f"({rest}) / l{i}{i} AS __y{i}")
    names = [f"__y{i}" for i in range(len(FEATURES))]
    return rows.selectExpr("*", *ys, " + ".join(f"{y} * {y}" for y in names) + " AS d2").drop(*names)


def _binned(rows: DataFrame, groups: DataFrame, key: str, n_groups: int, total: int) -> DataFrame:
    """rows with bin, that of their distance in their group, once for each start."""
    near = _with_distance(_joined(rows, groups, key, n_groups, total))
    return near.withColumn("bin", F.expr(f"cast(least(floor({BINS_PER_LOG} * log1p(d2)), {BINS}) AS int)"))


def _ranked(bins: DataFrame, *keys: str) -> DataFrame:
    """bins with of, the rows of all bins of the keys, and before, those of lower ones."""
    w = Window.partitionBy(*keys)
    lower = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return bins.withColumn("of", F.sum("n").over(w)).withColumn("before", F.coalesce(F.sum("n").over(lower), F.lit(0)))


def _step(rows: DataFrame, groups: DataFrame, key: str, n_groups: int, total: int) -> DataFrame:
    """One concentration step: mean and covariance of the CORE of each group with the smallest distances.

    Rows are summed per group and distance bin before the shuffle; the core is as many whole bins as hold it.
    """
    bins = _ranked(_sums(_binned(rows, groups, key, n_groups, total), key, "start", "bin"), key, "start")
    added = ["n", *(f"s{i}" for i in range(len(FEATURES))), *(f"q{i}{j}" for i, j in _pairs())]
    sums = bins.groupBy(key, "start").agg(
        F.first("of").alias("of"), *(F.expr(f"sum(CASE WHEN before < {CORE} * of THEN {c} END) AS {c}") for c in added)
    )
    return _estimate(sums, key, "start", "of")


def _least_determinants(rows: DataFrame, key: str) -> tuple[DataFrame, int]:
    """For each group its size of, m, l and volume; and the number of groups.

    After FEW steps from every start, the one with the least determinant (of equal ones the first by name) goes on. Each
    group stops by itself, when a step lowers the logarithm of its determinant by FALLS or less; the others go on until
    the last has stopped.
    """
    groups, total = cut(_starts(rows, key)), rows.count()
    n_groups = groups.where("start = 'quartiles'").count()
    starts = n_groups * (2 + SAMPLES)
    for _ in range(FEW):
        groups = packed(cut(_step(rows, packed(groups, starts), key, n_groups, total)), starts)
    best = groups.groupBy(key).agg(F.min_by(F.struct("*"), F.struct("volume", "start")).alias("best"))
    moving, stopped = packed(cut(best.select("best.*")), n_groups), []
    while not moving.isEmpty():
        was = moving.select(key, F.col("volume").alias("was"))
        stepped = packed(cut(_step(rows, moving, key, n_groups, total).join(was, key)), n_groups)
        falls = F.col("volume") < F.col("was") - FALLS
        stopped.append(stepped.where(~falls).drop("was"))
        moving = stepped.where(falls).drop("was")
    return reduce(DataFrame.unionByName, stopped, moving), n_groups


def _leaning(groups: DataFrame, languages: DataFrame, n_groups: int) -> DataFrame:
    """The estimates of groups (with lang), in which the language's counts as LEAN texts."""
    size = len(FEATURES)
    prior = languages.selectExpr("lang", *(f"m{i} AS p{i}" for i in range(size)), *(f"l{i}{j} AS k{i}{j}" for i, j in _pairs()))
    joined = groups.join(F.broadcast(prior) if n_groups <= BROADCAST_GROUPS else prior, "lang")
    out = ["gid", "of", f"of / cast(of + {LEAN} AS double) AS __w", *(f"m{i} AS __o{i}" for i in range(size))]
    for i, j in _pairs():
        own, its = (" + ".join(f"{f}{i}{k} * {f}{j}{k}" for k in range(j + 1)) for f in "lk")
        apart = f"__w * (1 - __w) * (__o{i} - p{i}) * (__o{j} - p{j})"
        out.append(f"__w * ({own}) + (1 - __w) * ({its}) + {apart} AS __v{i}{j}")
    means = joined.selectExpr(*out, *(f"__w * __o{i} + (1 - __w) * p{i} AS m{i}" for i in range(size)))
    return means.selectExpr("gid", "of", *(f"m{i}" for i in range(size)), *_cholesky({(i, j): f"__v{i}{j}" for i, j in _pairs()}))


def quality_verdicts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, statistics, base_failed, distance, kept) for each row of docs; needs doc_id, lang, source and text.

    kept is false where the base rules fail or where distance, the squared Mahalanobis distance from the group's robust
    centre, scaled so that the group's median is that of chi-squared, exceeds CUTOFF. Texts that fail the base rules take
    no part in the estimates. Null lang or source is a value of its own. Every group of a language and a source has
    its own estimate, in which the language's counts as LEAN texts. Null text is empty and fails. Repeated rows count as
    often as they stand there. An empty table gives none.
    """
    picked = docs.select(F.col("doc_id"), F.col("lang"), F.col("source"), F.col(text).alias("text"))
    stats = text_statistics(picked).select("doc_id", "lang", "source", "__stats.*")
    none = F.lit("\x00")
    language = F.translate(F.coalesce("lang", none), "\x01", "\x02")  # the first of the two parts it from the source
    rows = cut(
        stats.withColumns(_vector())
        .withColumns({"base_failed": base_failed(), "gid": F.concat(language, F.lit("\x01"), F.coalesce("source", none)), "lang": language})
        .drop("source")
    )
    fit = rows.where(~F.col("base_failed")).select("gid", "lang", *FEATURES)
    languages, _ = _least_determinants(fit.drop("gid"), "lang")
    own, n_groups = _least_determinants(fit, "gid")
    named = own.withColumn("lang", F.substring_index("gid", "\x01", 1))
    groups = cut(_leaning(named, languages, n_groups))
    total = fit.count()
    counted = _binned(fit.drop("lang"), groups, "gid", n_groups, total).groupBy("gid", "bin").agg(F.count("*").alias("n"))
    middle = _ranked(counted, "gid").where(F.col("before") + F.col("n") >= 0.5 * F.col("of")).groupBy("gid").agg(F.min("bin").alias("middle"))
    usual = F.greatest(F.expm1(F.col("middle") / BINS_PER_LOG), F.lit(0.25 * CHI2_MEDIAN)) / CHI2_MEDIAN
    known = cut(groups.join(middle.withColumn("usual", usual), "gid"))
    judged = _with_distance(_joined(rows.where(~F.col("base_failed")), known, "gid", n_groups, total))
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    distance = F.col("d2") / F.col("usual")
    passed = judged.select(*out, distance.alias("distance"), F.coalesce(distance <= CUTOFF, F.lit(True)).alias("kept"))
    failed = rows.where("base_failed").select(*out, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return passed.unionByName(failed)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    return quality_verdicts(read(spark, sf_dir, "documents")).drop("distance")


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules reject go: of rows that share an id, or have none, each is judged by its own text.

    Rows that agree in id, language, source and text stay or go together. Null text goes.
    """
    keyed = docs.select(whole_row(docs), row_key("doc_id", "lang", "source").alias("key"))
    judged = keyed.select(F.col("key").alias("doc_id"), "row.lang", "row.source", "row.text")
    gone = quality_verdicts(judged).where(~F.col("kept")).select(F.col("doc_id").alias("key")).distinct()
    return keyed.join(gone, "key", "left_anti").select("row.*")
