"""Registered queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` per
operator, and for most of them an equivalent DuckDB SQL text (the oracle).

The oracle reads the driver's base tables and inlines the derived tables of
``sources.fixtures`` as CTEs, so both sides start from the same parquet rows.
Oracle hygiene: counts are BIGINT, floats DOUBLE, averages rounded to 6 places,
dates are DATE, no array outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import schema
from ..sources import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all():
    # Importing the query modules fills the registry.
    from . import q_explore, q_features, q_model, q_recommend  # noqa: F401


# ---------------------------------------------------------------------------
# SQL text helpers shared by the oracle queries
# ---------------------------------------------------------------------------

def sql_with(views: list[str], extra: list[tuple[str, str]] = (), body: str = "") -> str:
    parts = [f"{n} as ({fx.view_sql(n, 'duckdb')})" for n in views]
    parts += [f"{n} as ({s})" for n, s in extra]
    return "with " + ",\n".join(parts) + "\n" + body


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_map(expr: str, pairs, default: str = "null") -> str:
    whens = " ".join(f"when {k} then {v}" for k, v in pairs)
    return f"(case {expr} {whens} else {default} end)"


def age_idx_sql(expr: str) -> str:
    return case_map(expr, [(c, i) for i, c in enumerate(schema.AGE_CODES)], "0")


def age_label_sql(expr: str) -> str:
    return case_map(expr, [(c, sql_str(lab)) for c, lab in zip(schema.AGE_CODES, schema.AGE_LABELS)])


def occupation_label_sql(expr: str) -> str:
    return case_map(expr, [(i, sql_str(lab)) for i, lab in enumerate(schema.OCCUPATION_LABELS)])


def gender_idx_sql(expr: str) -> str:
    return f"(case when {expr} = 'F' then 1 else 0 end)"


def zip_idx_sql(expr: str) -> str:
    return (f"coalesce(case when regexp_matches({expr}, '^\\s*[0-9]') "
            f"then cast(regexp_extract({expr}, '^\\s*([0-9])', 1) as integer) end, 10)")


def genre_parts_sql(expr: str) -> str:
    """Stripped names of a pipe-joined genre string (null -> empty list)."""
    return f"list_transform(string_split(coalesce({expr}, ''), '|'), lambda x: trim(x))"


def genre_flags_sql(parts: str) -> list[str]:
    return [f"(case when list_contains({parts}, {sql_str(g)}) then 1 else 0 end)" for g in schema.GENRES]


def genre_mask_sql(parts: str) -> str:
    return "(" + " + ".join(f"{1 << i}*{f}" for i, f in enumerate(genre_flags_sql(parts))) + ")"


def multihot_string_sql(parts: str) -> str:
    return "(" + " || ".join(f"cast({f} as varchar)" for f in genre_flags_sql(parts)) + ")"
