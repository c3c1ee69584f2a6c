"""Checks on report parameters; a bad one raises before any job starts."""

from __future__ import annotations

from collections.abc import Sequence


def required(value, what: str):
    if value is None:
        raise ValueError(f"{what} cannot be NULL.")
    return value


def required_text(value: str | None, what: str) -> str:
    """Trimmed text; NULL and blank are refused."""
    if value is None or not value.strip():
        raise ValueError(f"{what} cannot be NULL or empty.")
    return value.strip()


def required_list(values: Sequence[str] | None, what: str) -> list[str]:
    if not values:
        raise ValueError(f"{what} cannot be NULL or empty.")
    return list(values)
