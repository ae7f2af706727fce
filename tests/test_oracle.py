"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from cadenza.plans import files, further, later, more, registry  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(rows):
    def cell(v):
        if v is None:
            return "~"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    return sorted(tuple(map(cell, r)) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = duck.execute(f"select {quoted} from ({registry.SQL[name]})").fetchall()
    assert canon(map(tuple, df.select(*columns).collect())) == canon(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() >= 0


def test_entry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def both(spark, path, name, **tables):
    """Rows of a query over made tables, and of its SQL."""
    con = duckdb.connect()
    for table, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{table}.parquet")
        con.execute(f"create view {table} as select * from '{path}/{table}.parquet/*.parquet'")
    df = registry.QUERIES[name](spark, str(path))
    columns = sorted(df.columns)
    want = con.execute(f"""select {", ".join(f'"{c}"' for c in columns)} from ({registry.SQL[name]})""").fetchall()
    return canon(map(tuple, df.select(*columns).collect())), canon(want)


@pytest.mark.parametrize("name", ["fn12_negation_lost", "fn14_completeness", "fn14_completeness_check"])
def test_pairs_of_any_script(spark, tmp_path, name):
    """Words inside longer words of letters beyond ASCII, negation and numbers of the target."""
    pairs = [
        ("noñiedoja ñno", "si"), ("No, never", "да"), ("never", "никогда"), ("not free", "бесплатный"), ("no 12 of 005", "двенадцать и пятый"),
        ("I don’t know", "не знаю"), ("it isn’tñ", "да"), ("not only", "да"), ("21000 and 000 and 7", "Двадцать одна тысяча"),
        ("12345678901 or 345", "один"), ("nothing\nat all", "всё"), (None, "x"), ("no", None), ("no 5", ""),
    ]
    rows = [(k, t, role, text) for k, pair in enumerate(pairs) for t, (role, text) in enumerate(zip(("user", "assistant"), pair, strict=True))]
    got, want = both(spark, tmp_path, name, conversations=spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert got == want


def test_replaced_videos_without_rows_stay(spark, tmp_path):
    """Video 87's sentence 0 has no draft row, so it has no row of even id to be written again."""
    docs = spark.createDataFrame([(87, "One. Two."), (3, "One. Two. Three."), (1, "One.")], "doc_id bigint, text string")
    got, want = both(spark, tmp_path, "snk1_replace_artifacts", documents=docs, labels=docs.select("doc_id"))
    assert got == want and ("1", "Two.", "87") in got and ("0", "new One.", "3") in got
