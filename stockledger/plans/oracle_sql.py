"""Oracle SQL keyed like ``catalog.queries()``."""

from __future__ import annotations

from .catalog import BAND
from .oracle import oracle_queries


def oracle_sql() -> dict[str, str]:
    return oracle_queries(band=BAND)
