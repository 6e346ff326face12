"""Connected components of an edge table."""

from __future__ import annotations

from runnel.operators.graph import connected as components

__all__ = ["components"]
