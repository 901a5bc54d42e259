"""Registered queries: every operator run over the given tables, with the SQL it must equal."""
from . import (  # noqa: F401
    detection, expressions, fidelity, filters, kpis, profiling, quality, scopes, series, sets, sources,
)
from .base import REGISTERED  # noqa: F401
