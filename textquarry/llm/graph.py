"""Connected components of a graph that is never in one place."""

from __future__ import annotations

from ..operators.components import components

__all__ = ["components"]
