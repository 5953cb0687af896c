"""Runs a registered query in Spark and its SQL in DuckDB, and compares them."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

# how DuckDB type names correspond to Spark's
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def database(folder: str):
    db = duckdb.connect()
    for name in TABLES.split():
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return db


def _key(row):
    return tuple((v is None, str(type(v)), repr(v)) for v in row)


def _plain(value):
    # by spelling, so that 0.0 and -0.0 differ and NaN equals itself
    return repr(value) if isinstance(value, float) else value


def difference(spark_df, relation) -> str | None:
    """Why the results differ, or None."""
    ours = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    theirs = dict(zip(relation.columns, map(str, relation.types), strict=True))
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    wrong = {c: (t, theirs[c]) for c, t in ours.items() if SAME_TYPE.get(t) != theirs[c]}
    if wrong:
        return f"types {wrong}"
    names = sorted(ours)
    got = sorted((tuple(_plain(r[c]) for c in names) for r in spark_df.collect()), key=_key)
    order = [relation.columns.index(c) for c in names]
    want = sorted((tuple(_plain(r[i]) for i in order) for r in relation.fetchall()), key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w:
            return f"{names}: {str(g)[:400]} != {str(w)[:400]}"
    return None
