"""URL filters by a sort-merge range join.

A host written backwards (org.example.blog.) turns a domain and all its subdomains into one interval of keys, so rules
become nested intervals. Keys and interval starts are sorted together and swept once; a stack holds the rules whose
interval is still open, and among those whose path also fits the longest wins.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import ascii_lower, in_batches, read

#: host, path, verdict. A rule holds for the host and its subdomains where the path starts with the rule's.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Verdict where no rule fits.
DEFAULT = "allow"
#: Keys looked at to choose where the ranges of tasks end; it decides balance only, not results.
SPLIT_SAMPLE = 4096
#: Greater than any text that a domain's keys go on with.
AFTER = "\U0010ffff"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty without ://."""
    whole = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(whole, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def backwards(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class _Open:
    """Rules of one domain, by path."""

    def __init__(self, domain: str) -> None:
        self.domain, self.paths, self.lengths = domain, {}, []

    def add(self, path: str, name: str, verdict: str) -> None:
        self.paths[path] = (len(name), name, verdict)
        self.lengths = sorted({len(p) for p in self.paths}, reverse=True)

    def longest(self, path: str) -> tuple[int, str | None, str] | None:
        return next((self.paths[p] for n in self.lengths if len(p := path[:n]) == n and p in self.paths), None)


def _sweep(batches: Iterator[dict[str, list]]) -> Iterable[dict[str, list]]:
    """Rows by range, domain, and rules before urls. A task may hold several ranges; each starts with an empty stack."""
    stack: list[_Open] = []
    now = None
    for b in batches:
        out: dict[str, list] = {k: [] for k in ("page_id", "host", "path", "rule", "verdict")}
        for at, domain, is_url, page_id, host, path, verdict in zip(
            *(b[k] for k in ("range", "domain", "is_url", "page_id", "host", "path", "verdict")), strict=True
        ):
            if at != now:
                stack, now = [], at
            while stack and not domain.startswith(stack[-1].domain):
                stack.pop()
            if not is_url:
                if not stack or stack[-1].domain != domain:
                    stack.append(_Open(domain))
                stack[-1].add(path, host + path, verdict)
                continue
            best = max((x for s in stack if (x := s.longest(path))), default=(0, None, DEFAULT))
            for k, v in zip(out, (page_id, host, path, best[1], best[2]), strict=True):
                out[k].append(v)
        if out["page_id"]:
            yield out


def _ends(urls: DataFrame) -> list[tuple[str, str]]:
    """Where ranges end: quantiles of a hash sample of about SPLIT_SAMPLE (domain, path), as many as shuffle partitions."""
    n = urls.count()
    parts = min(int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions")), SPLIT_SAMPLE // 4)
    share = 1 << 20
    some = urls.where(F.pmod(F.xxhash64("page_id", "domain", "path"), F.lit(share)) < share * SPLIT_SAMPLE / max(n, 1))
    keys = sorted((r["domain"], r["path"]) for r in some.select("domain", "path").limit(4 * SPLIT_SAMPLE).collect())
    return [keys[len(keys) * i // parts] for i in range(1, parts)] if keys else []


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of pages; rules has host, path and verdict.

    The longest rule (host and path together; of equal ones the greater text) wins; without one, rule is null and the
    verdict is DEFAULT. Null urls and urls without :// have an empty host and path. Repeated rows are judged each by
    itself. Rules with a null host or path are dropped; of two for one host and path the greater verdict holds. An
    empty table gives none. Other columns are ignored.

    Both sides are dealt out by key ranges whose ends are quantiles of a bounded sample. A key that fills several ranges
    (one host and path may hold a third of all rows) is dealt over them by a hash of the row; a rule goes to every
    range that its interval meets. So neither side is broadcast and no range gets a group that must stay whole.
    """
    named = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    kind = named.schema["page_id"].dataType.simpleString()
    host, path = url_parts(F.col("url"))
    urls = named.select("page_id", host.alias("host"), path.alias("path")).withColumn("domain", backwards(F.col("host")))
    ends = _ends(urls)

    def deal_urls(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for b in batches:
            keys = list(zip(b["domain"], b["path"], strict=True))
            low, high = ([f(ends, k) for k in keys] for f in (bisect_left, bisect_right))
            yield b | {"range": [i + s % (j - i + 1) for i, j, s in zip(low, high, b["salt"], strict=True)]}

    def deal_rules(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for b in batches:
            met = [
                (i, r)
                for i, d in enumerate(b["domain"])
                for r in range(bisect_left(ends, (d, "")), bisect_right(ends, (d + AFTER, "")) + 1)
            ]
            yield {k: [v[i] for i, _ in met] for k, v in b.items()} | {"range": [r for _, r in met]}

    dealt = in_batches(
        urls.withColumn("salt", F.pmod(F.xxhash64("page_id", "domain", "path"), F.lit(1 << 30))),
        deal_urls,
        f"range int, domain string, page_id {kind}, host string, path string",
    )
    known = (
        rules.where("host is not null and path is not null")
        .groupBy(ascii_lower(F.col("host")).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("domain", backwards(F.col("host")))
    )
    opened = in_batches(known, deal_rules, "range int, domain string, host string, path string, verdict string")
    left = dealt.select("range", "domain", F.lit(1).alias("is_url"), "page_id", "host", "path", F.lit("").alias("verdict"))
    right = opened.select(
        "range", "domain", F.lit(0).alias("is_url"), F.lit(None).cast(kind).alias("page_id"), "host", "path", "verdict"
    )
    both = left.unionByName(right).repartition(len(ends) + 1, "range").sortWithinPartitions("range", "domain", "is_url")
    return in_batches(both, _sweep, f"page_id {kind}, host string, path string, rule string, verdict string")


def op6_urls(spark, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


OP6_SQL = r"""
WITH r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT page_id, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS cut FROM pages),
t AS (SELECT page_id, CASE WHEN cut > 0 THEN substr(url, cut + 3) ELSE '' END AS rest FROM u),
s AS (SELECT page_id,
        translate(regexp_extract(rest, '(?s)^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM t),
best AS (SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
         FROM s LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
"""
