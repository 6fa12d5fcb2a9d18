"""Registered queries and their SQL twins."""

from __future__ import annotations

import importlib

_MODULES = (
    "text_queries", "eda_queries", "moderation_queries", "talk_queries", "model_queries",
    "stream_queries",
)


def load():
    """Import every query module once and return the registry."""
    for name in _MODULES:
        importlib.import_module(f"modlake.checks.{name}")
    return importlib.import_module("modlake.checks.registry")
