"""Every registered query with its SQL; the modules of this package add to both."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    """Register a callable of (spark, sf_dir) under its own name, with SQL of equal results."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


from lanefold.plans import assembly, audits, parsing, records, samples, sequencing, streams, verdicts  # noqa: E402, F401  they register themselves
