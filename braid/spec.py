"""Reading keys out of the dicts that describe an input or an output."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

_MISSING = object()


def get(spec: dict, key: str, default: Any = _MISSING) -> Any:
    """Value of ``key`` in the spec or in its ``config``; ``ValueError`` if it has to be there."""
    for place in (spec, spec.get("config") or {}):
        if place.get(key) is not None:
            return place[key]
    if default is _MISSING:
        raise ValueError(f"key '{key}' is missing")
    return default


def flag(spec: dict, key: str, default: bool = False) -> bool:
    """A yes/no key, given as a bool or as the text ``true`` / ``false``."""
    value = str(get(spec, key, default)).strip().lower()
    if value not in ("true", "false"):
        raise ValueError(f"key '{key}' must be true or false")
    return value == "true"


def store_type(spec: dict, role: str) -> str:
    """Kind of store: the ``type``, or else the ``datasource`` / ``datasink`` where that names a file store."""
    named = str(spec.get(role) or "")
    kind = get(spec, "type", named if named in ("FILES", "HDFS", "S3") else None)
    if kind is None:
        raise ValueError(f"{role} '{named}' has no 'type' in its config")
    return str(kind).lower()


def format_options(spec: dict, keys: tuple[str, ...] = ()) -> dict[str, str]:
    """Spark reader / writer options named in ``keys``, plus everything under ``options``."""
    named = {key: get(spec, key, None) for key in keys}
    chosen = {key: value for key, value in named.items() if value is not None}
    chosen.update(spec.get("options") or {})
    return {key: str(value).lower() if isinstance(value, bool) else str(value) for key, value in chosen.items()}


@contextmanager
def numbered(role: str, number: int) -> Iterator[None]:
    """Say in an error which input or output it is about."""
    try:
        yield
    except ValueError as error:
        raise ValueError(f"{role} {number}: {error}") from error
