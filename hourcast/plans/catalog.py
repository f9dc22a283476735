"""Query catalog: every registered query reads the driver tables and runs one or more operators.

``register(name, oracle=...)`` records a callable ``(spark, sf_dir) -> DataFrame`` and, where the
operator is SQL-expressible, the DuckDB SQL that computes the same result from the raw tables.

Result convention shared by both sides (so row hashes compare):
integers -> BIGINT, floating -> DOUBLE rounded to 6 digits, timestamps -> 'yyyy-MM-dd HH:mm:ss'
text, dates -> 'yyyy-MM-dd' text. ``normalize`` applies it to the Spark side; oracle SQL applies it
explicitly (see ``sql_norm``).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.functions.numeric import stable_round, stable_round_sql

DIGITS = 6

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}
_NOTES: dict[str, str] = {}


def normalize(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = stable_round(c.cast("double"), digits)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.BooleanType):
            c = c.cast("boolean")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, oracle: str | None = None, note: str | None = None, raw: bool = False):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return out if raw else normalize(out)
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = run
        if oracle is not None:
            _ORACLE[name] = oracle.strip()
        if note:
            _NOTES[name] = note
        return fn
    return deco


def sql_norm(inner: str, doubles=(), ints=(), ts=(), dates=(), digits: int = DIGITS, with_: str = "") -> str:
    """Wrap oracle SQL so its result follows the shared result convention."""
    rep = []
    rep += [f'{stable_round_sql(chr(34) + c + chr(34), digits)} AS "{c}"' for c in doubles]
    rep += [f'CAST("{c}" AS BIGINT) AS "{c}"' for c in ints]
    rep += [f"strftime(\"{c}\", '%Y-%m-%d %H:%M:%S') AS \"{c}\"" for c in ts]
    rep += [f"strftime(\"{c}\", '%Y-%m-%d') AS \"{c}\"" for c in dates]
    body = f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{inner}\n) AS q" if rep else f"SELECT * FROM (\n{inner}\n) AS q"
    return f"{with_}\n{body}" if with_ else body


def printed(expr: str, digits: int) -> str:
    """Oracle of ``round_exact``: what C's printf prints, read back."""
    return f"CAST(printf('%.{digits}f', round(CAST({expr} AS DOUBLE), 10)) AS DOUBLE)"


def _load_all() -> None:
    # Importing the query modules fills the registry.
    from hourcast.plans import (q_advice, q_clean, q_features, q_ingest, q_model, q_model_input,  # noqa: F401
                                q_pipelines, q_profile, q_stored, q_tests, q_variants)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def notes() -> dict[str, str]:
    _load_all()
    return dict(_NOTES)
