"""Registered queries with their SQL twins, one module per group of operators."""

from __future__ import annotations

from .registry import oracles, registered

__all__ = ["oracles", "registered"]
