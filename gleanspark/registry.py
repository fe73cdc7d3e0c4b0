"""All queries of the engine's own operators, with DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from gleanspark.plans import cases  # noqa: F401  (registers its queries)
from gleanspark.plans.catalog import ORACLE_SQL, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
