"""Side-by-side run of a query and its SQL: same columns, same kinds of type, same rows."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(type_name):
    name = str(type_name).lower().split("(")[0]
    for label, names in {
        "whole": ("tinyint", "smallint", "int", "integer", "bigint", "hugeint"),
        "real": ("double", "float", "decimal"),
        "text": ("string", "varchar"),
        "time": ("timestamp", "timestamp_ntz"),
    }.items():
        if name in names:
            return label
    return name


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def compare(spark, con, run, sql, sf_dir):
    """Rows on both sides; raises AssertionError with the first differences."""
    df = run(spark, sf_dir)
    names = sorted(df.columns)
    types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    rel = con.sql(sql)
    oracle_types = {n: kind(t) for n, t in zip(rel.columns, rel.types)}
    assert sorted(rel.columns) == names, (sorted(rel.columns), names)
    assert types == oracle_types, {n: (types[n], oracle_types[n]) for n in names if types[n] != oracle_types[n]}
    ours = sorted([tuple(plain(r[n]) for n in names) for r in df.collect()])
    place = [rel.columns.index(n) for n in names]
    theirs = sorted([tuple(plain(r[i]) for i in place) for r in rel.fetchall()])
    if ours != theirs:
        extra, lacking = set(ours) - set(theirs), set(theirs) - set(ours)
        raise AssertionError(
            f"{names}\nspark {len(ours)} rows, sql {len(theirs)} rows\n"
            f"only spark: {sorted(extra)[:3]}\nonly sql: {sorted(lacking)[:3]}"
        )
    return len(ours)
