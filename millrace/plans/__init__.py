"""Registered queries by theme, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from importlib import import_module

THEMES = ("etl", "markdown", "trust", "streams", "learning", "scoring")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for theme in THEMES:
        merged.update(getattr(import_module(f"{__name__}.{theme}"), attribute))
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")
