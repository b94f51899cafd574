"""Registered queries over the star-schema tables, with the SQL that gives the same rows."""

from checks import (  # noqa: F401
    adhoc,
    changes,
    errors,
    functions,
    lineage,
    load,
    normalize,
    planning,
    schema,
    sources,
    streams,
)
from checks.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
