"""Spark result and DuckDB result of a registered query, as sorted rows with columns by name."""

import duckdb

import __spark_entry__ as contract

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def both(spark, name, sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = contract.queries()[name](spark, sf)
    columns = sorted(df.columns)
    result = con.sql(contract.oracle_sql()[name])
    place = [result.columns.index(c) for c in columns]
    return (sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str),
            sorted((tuple(r[i] for i in place) for r in result.fetchall()), key=str))
