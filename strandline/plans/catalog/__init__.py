"""Named queries over the test tables, most with an equivalent SQL statement.

Every query reads whole tables. Source-shaped inputs (collision records,
forecast documents, camera frames, WAV files) are derived from table columns.
"""

from __future__ import annotations

from strandline.plans.catalog import exploitation, landing, sinks, streaming, trusted

_MODULES = (landing, trusted, exploitation, streaming, sinks)


def queries() -> dict:
    return {name: fn for m in _MODULES for name, (fn, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, (_, sql) in m.QUERIES.items() if sql}
