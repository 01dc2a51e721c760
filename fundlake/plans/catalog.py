"""All registered queries: import order fixes registration order."""

from __future__ import annotations

from . import ingest_queries  # noqa: F401
from . import allocation_queries  # noqa: F401
from . import statement_queries  # noqa: F401
from . import verify_queries  # noqa: F401
from .registry import COVERS, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "COVERS"]
