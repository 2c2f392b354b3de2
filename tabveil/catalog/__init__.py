"""Registered queries over the test tables and their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

GROUPS = ("prepare", "measuring", "synthesis", "utility")


def registered() -> dict:
    """name -> (query, SQL or None)."""
    found: dict = {}
    for group in GROUPS:
        found |= import_module(f"tabveil.catalog.{group}").QUERIES
    return found
