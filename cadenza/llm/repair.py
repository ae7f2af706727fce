"""Conversation structure repair: cheapest edits by auction shortest paths over a lattice of turns and role states.

A node is a place between two turns and what the repaired roles so far ask for next; arcs are the edits, with small whole
costs. An auction raises node prices from nothing: a path from the origin is extended along an arc whose cost and price are
the node's own price, or contracted after raising that price, until it ends. Prices then show which arcs are tight, and the
audit is the least string of tight arcs that lead to the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import arrow_schema, read
from cadenza.llm.trie import CRC32

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing kept yet, behind a system turn, behind a user turn, behind an assistant's.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: Where a state's next role leads: only a user turn may follow all but a user turn.
NEXT = {NONE: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: Turns in a block of the lattice. Blocks are solved from the last to the first, each with the prices of the next.
BLOCK = 64
SPACES = " \t\n\v\f\r"


def _arcs(symbols: str, last: bool, exits: list[int]) -> list[list[tuple[int, str, int]]]:
    """Arcs (cost, label, node) of each node of a block; node 4 * place + state, the end behind them all."""
    n = len(symbols) // 2
    end = 4 * (n + 1)
    out: list[list[tuple[int, str, int]]] = []
    for i in range(n + 1):
        for state in range(4):
            to = NEXT[state][1]
            arcs = [(INSERT, "I", 4 * i + to)] if i < n or last else []
            if i == n:
                if exits[state] is not None:
                    arcs.append((exits[state], "", end))
            else:
                role, fault = symbols[2 * i], symbols[2 * i + 1]
                arcs.append((DELETE, "D", 4 * (i + 1) + state))
                if fault in "-t":
                    more = TRUNCATED if fault == "t" else 0
                    arcs.append((REROLE + more, "R", 4 * (i + 1) + to))
                    if role == NEXT[state][0][0]:
                        arcs.append((more, "K", 4 * (i + 1) + to))
                    elif role == "s" and state == NONE:
                        arcs.append((more, "K", 4 * (i + 1) + SYSTEM))
            out.append(arcs)
    return out


def _auction(arcs: list, price: list[int], origin: int) -> None:
    """Raise prices until a path from origin reaches the end, the last node; then price[origin] is its distance."""
    end = len(price) - 1
    path = [origin]
    while path[-1] != end:
        here = path[-1]
        least, to = min((cost + price[j], j) for cost, _, j in arcs[here])
        if price[here] < least:
            price[here] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


def _leading(arcs: list, price: list[int]) -> list[bool]:
    """Whether tight arcs lead from a node to the end: places from the last, and in a place by price."""
    out = [False] * (len(arcs) + 1)
    out[-1] = True
    for i in reversed(range(0, len(arcs), 4)):
        for node in sorted(range(i, i + 4), key=price.__getitem__):
            out[node] = any(out[j] and price[node] == cost + price[j] for cost, _, j in arcs[node])
    return out


def solve(symbols: str) -> tuple[int, str]:
    """Cost and audit for turns given as two characters each: role initial (s, u, a, else -) and fault (b, d, t, else -)."""
    blocks, exits, cost = [], [0, None, None, 0], 0
    starts = range(0, max(len(symbols), 1), 2 * BLOCK)
    for start in reversed(starts):
        arcs = _arcs(symbols[start : start + 2 * BLOCK], start == starts[-1], exits)
        price = [0] * (len(arcs) + 1)
        for origin in range(4):
            _auction(arcs, price, origin)
        blocks.append((arcs, price))
        cost += min(price[:4])  # only differences go on, so that prices in a block need not rise to the whole cost
        exits = [p - min(price[:4]) for p in price[:4]]
    audit, node = [], NONE
    for arcs, price in reversed(blocks):
        leads = _leading(arcs, price)
        while True:
            label, to = min((label, j) for cost, label, j in arcs[node] if leads[j] and price[node] == cost + price[j])
            if to == len(arcs):
                break
            audit.append(label)
            node = to
        node %= 4
    return cost + exits[NONE], "".join(audit)


def _apply(turns: list[tuple[str, str]], audit: str) -> list[dict]:
    """The repaired turns."""
    out, state, rows = [], NONE, iter(turns)
    for edit in audit:
        role, to = NEXT[state]
        if edit == "I":
            out.append({"role": role, "text": ""})
        else:
            was, text = next(rows)
            if edit == "D":
                continue
            if edit == "K" and was[:1] == "s":
                to = SYSTEM
            out.append({"role": was if edit == "K" else role, "text": text})
        state = to
    return out


def repair(turns: list[tuple[int | None, str, str]], known: Callable[[str], tuple[int, str]] = solve) -> dict:
    """Counts, cost, audit and repaired turns of one conversation's (turn, role, text) in order.

    known solves short conversations, of which many look alike.
    """
    seen: set[tuple[str, str]] = set()
    symbols, faults = [], {"b": 0, "d": 0, "t": 0, "-": 0}
    for _, role, text in turns:
        body = text.rstrip(SPACES)
        fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-"
        seen.add((role, text))
        faults[fault] += 1
        symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "-") + fault)
    numbers = {t for t, _, _ in turns if t is not None}
    initials = [role[:1] for _, role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    pattern = "".join(symbols)
    cost, audit = known(pattern) if len(turns) <= BLOCK else solve(pattern)
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        "blank": faults["b"], "duplicate": faults["d"], "truncated": faults["t"], "illegal": illegal,
        "cost": cost, "audit": audit, "repaired": _apply([t[1:] for t in turns], audit),
    }


def repair_conversations(turns: DataFrame) -> DataFrame:
    """One row for each conv_id of turns (conv_id, turn, role, text, present): what is wrong, and the cheapest repair.

    Columns: conv_id; gaps, turn numbers missing between the least and the greatest; blank, duplicate and truncated turns, by
    each turn's first fault; illegal neighbours; cost and audit of the cheapest edits (Keep, Rerole, Delete, Insert) that
    leave one system turn at most, then user and assistant by turns; repaired, an array of role and text. Ties go to the
    least audit. Turns stand by number, null first, then role, then text. Null roles and texts are one space. Rows that
    are not present only name their conversation. A null conv_id is one conversation. An empty table gives none. Other
    columns are ignored. A task reads its conversations as a stream and holds one at a time.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
        " audit string, repaired array<struct<role:string,text:string>>"
    )
    kinds = arrow_schema(turns.sparkSession, schema)
    none = F.lit(" ")
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text"), "present")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, key, held = lru_cache(1 << 16)(solve), None, []

        def close() -> dict:
            return {"conv_id": key} | repair([(r["turn"], r["role"], r["text"]) for r in held if r["present"]], known)

        for b in batches:
            out = []
            for now, some in groupby(b.to_pylist(), lambda r: r["conv_id"]):
                if held and now != key:
                    out.append(close())
                    held = []
                key = now
                held += some
            yield pa.RecordBatch.from_pylist(out, kinds)
        if held:
            yield pa.RecordBatch.from_pylist([close()], kinds)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(run, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage by crc32(`conv_id:turn`) % 20; dropped rows stay, not present."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    t = turns.select(
        "conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")),
        (F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20).alias("harm"),
    )
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    times = F.sequence(F.lit(1), F.when(F.col("harm") == 3, 2).otherwise(1))
    return t.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("harm") != 0).alias("present"), F.explode(times).alias("time")).drop("time")


def op13_repair(spark, sf_dir: str) -> DataFrame:
    out = repair_conversations(damaged(read(spark, sf_dir, "conversations")))
    lines = F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    return out.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n").cast("binary"), 256)).drop("repaired")


_SHOWN = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
#: Insertions never pay: with one goes a neighbour that deleting makes cheaper. So the audit has a letter for each row.
OP13_SQL = f"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC32.format(_SHOWN)} % 20 AS harm FROM conversations
), hurt AS (
    SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
        CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM given, unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) WHERE harm <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        rtrim(text, E' \\t\\n\\x0B\\f\\r') AS body FROM hurt
), turns AS (
    SELECT *, left(role, 1) AS r, CASE WHEN body = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed
), paths AS (
    SELECT conv_id, 0::BIGINT AS i, 'n' AS state, {{'cost': 0::BIGINT, 'audit': ''}} AS best FROM turns WHERE i = 1
    UNION ALL
    SELECT p.conv_id, t.i, a.arc.state AS state, min({{'cost': p.best.cost + a.arc.cost, 'audit': p.best.audit || a.arc.edit}}) AS best
    FROM paths p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1, unnest([
        {{'edit': 'D', 'cost': 2, 'state': p.state, 'ok': true}},
        {{'edit': 'K', 'cost': CASE t.fault WHEN 'truncated' THEN 5 ELSE 0 END, 'state': t.r,
          'ok': t.fault NOT IN ('blank', 'duplicate') AND p.state || t.r IN ('ns', 'nu', 'su', 'au', 'ua')}},
        {{'edit': 'R', 'cost': CASE t.fault WHEN 'truncated' THEN 6 ELSE 1 END, 'state': CASE p.state WHEN 'u' THEN 'a' ELSE 'u' END,
          'ok': t.fault NOT IN ('blank', 'duplicate')}}]) AS a(arc)
    WHERE a.arc.ok GROUP BY ALL
), sizes AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
), audits AS (
    SELECT s.conv_id, min(p.best) AS best FROM sizes s JOIN paths p ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.i = s.n
    WHERE p.state IN ('n', 'a') GROUP BY s.conv_id
), edited AS (
    SELECT t.*, a.best.audit[t.i] AS edit, row_number() OVER (PARTITION BY t.conv_id ORDER BY t.i) AS m,
        max(CASE WHEN a.best.audit[t.i] = 'K' AND t.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY t.conv_id) AS led
    FROM turns t JOIN audits a ON a.conv_id IS NOT DISTINCT FROM t.conv_id WHERE a.best.audit[t.i] <> 'D'
), texts AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (m - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || text, chr(10) ORDER BY i) AS text FROM edited GROUP BY conv_id
)
SELECT c.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
    coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal, coalesce(a.best.cost, 0) AS cost,
    coalesce(a.best.audit, '') AS audit, sha256(coalesce(x.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
"""
