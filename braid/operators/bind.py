"""Names and placeholders in a query's text."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from braid.spec import get

# Stretches of SQL text in which nothing is replaced. Hints look like comments but name tables.
_LITERAL = r"""[rR]'[^']*' | [rR]"[^"]*" | '(?:[^'\\]|\\.|'')*' | "(?:[^"\\]|\\.|"")*" | `(?:[^`]|``)*`"""
_OPENING = re.compile(rf"(?P<literal>{_LITERAL}) | (?P<line>--[^\n]*) | (?P<block>/\*(?!\+))", re.X | re.S)
_PLACEHOLDER = re.compile(r"\$COND\{(?P<condition>\d+)\}")
_WORD = re.compile(r"[A-Za-z_]\w*")

# How a file path is spelled as a name, by the datasource it comes from.
_PATH_PREFIXES = {"S3": ("s3a://", "S3."), "FILES": ("file://", "FILES"), "HDFS": ("hdfs://", "HDFS")}


def input_name(spec: dict) -> str:
    """The name by which a query refers to an input.

    ``name`` if given; ``SOURCE.database[.schema].table`` for a table; for a file its path with dots
    for slashes, after ``S3.``, ``FILES`` or ``HDFS``.
    """
    if spec.get("name"):
        return spec["name"]
    source = spec.get("datasource") or ""
    if source in _PATH_PREFIXES and spec.get("file-path"):
        scheme, prefix = _PATH_PREFIXES[source]
        path = re.sub(r"^s3n?://", "s3a://", spec["file-path"])
        path = re.sub(r"^(file|hdfs):/(?!/)", r"\1:///", path)
        path = path if path.startswith(scheme) else scheme + path
        return path.replace(scheme, prefix, 1).rstrip("/").replace("/", ".")
    if source and spec.get("database"):
        schema = get(spec, "schema", None)
        table = get(spec, "table", None) or get(spec, "collection")
        levels = [source, spec["database"], schema if isinstance(schema, str) else None, table]
        return ".".join(level for level in levels if level)
    raise ValueError("an input needs a 'name', or 'datasource' with 'database' and 'table' or a file path")


def view_name(name: str) -> str:
    """A view name that no other run in the session uses."""
    return f"v_{re.sub(r'[^A-Za-z0-9]+', '_', name)}_{uuid.uuid4().hex}"


def _parts(sql: str) -> Iterator[tuple[str, str]]:
    """The text in order, as ``code``, ``literal`` and ``comment``. Block comments nest, as in Spark's grammar."""
    at = 0
    while at < len(sql):
        opening = _OPENING.search(sql, at)
        if opening is None:
            yield "code", sql[at:]
            return
        if opening.start() > at:
            yield "code", sql[at : opening.start()]
        end = _block_end(sql, opening.start()) if opening["block"] else opening.end()
        yield "literal" if opening["literal"] else "comment", sql[opening.start() : end]
        at = end


def _block_end(sql: str, start: int) -> int:
    depth = 0
    for mark in re.compile(r"/\*|\*/").finditer(sql, start):
        depth += 1 if mark[0] == "/*" else -1
        if depth == 0:
            return mark.end()
    return len(sql)


def fill_conditions(sql: str, conditions: list[str]) -> str:
    """Put the n-th condition, as it is, in place of ``$COND{n}``, also within quotes, but not in comments."""
    used = set()

    def fill(match: re.Match) -> str:
        number = int(match["condition"])
        if not 1 <= number <= len(conditions):
            raise ValueError(f"$COND{{{number}}} has no value: {len(conditions)} dynamic conditions are given")
        used.add(number)
        return str(conditions[number - 1])

    filled = "".join(text if kind == "comment" else _PLACEHOLDER.sub(fill, text) for kind, text in _parts(sql))
    unused = sorted(set(range(1, len(conditions) + 1)) - used)
    if unused:
        raise ValueError(f"dynamic conditions {unused} are not used in the query")
    return filled


def bind_names(sql: str, views: dict[str, str]) -> str:
    """Bind each input's name to its view, and drop a last ``;``.

    A name of several parts is replaced by its view, outside literals and comments, longer names first, so that a name that
    begins like another one still finds its own view. A name that is one word may also be a column, an alias or a parameter;
    it stays as it is and becomes a name that the query starts with.
    """
    plain = {name: view for name, view in views.items() if _WORD.fullmatch(name)}
    names = "|".join(re.escape(name) for name in sorted(views.keys() - plain, key=len, reverse=True)) or r"(?!)"
    named = re.compile(rf"(?<![\w.$])(?:{names})(?!\w)")
    parts = list(_without_last_semicolon(list(_parts(sql))))
    bound = "".join(named.sub(lambda match: views[match[0]], text) if kind == "code" else text for kind, text in parts)
    if not plain:
        return bound
    given = ", ".join(f"{name} AS (TABLE {view})" for name, view in plain.items())
    return f"WITH {given} ({bound}\n)"


def _without_last_semicolon(parts: list[tuple[str, str]]) -> list[tuple[str, str]]:
    for number in range(len(parts) - 1, -1, -1):
        kind, text = parts[number]
        if kind == "code" and text.strip():
            if text.rstrip().endswith(";"):
                head, _, tail = text.rpartition(";")
                parts[number] = ("code", head + tail)
            break
        if kind == "literal":
            break
    return parts
