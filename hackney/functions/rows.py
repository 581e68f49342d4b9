"""Rows made of expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def inline_rows(rows: Sequence[Mapping[str, str]]) -> str:
    """A generator that turns one input row into these rows."""
    structs = [
        "struct(" + ", ".join(f"{sql} AS {name}" for name, sql in row.items()) + ")" for row in rows
    ]
    return f"inline(array({', '.join(structs)}))"


def computed_once(columns: dict[str, str]) -> str:
    """Columns by name, worked out once a row whatever names them later.

    A projection is merged into those that follow it, and a filter is moved before it, so that a costly column is worked out each
    time it is named. A generator of one row is passed by neither.
    """
    fields = ", ".join(f"'{name}', {sql}" for name, sql in columns.items())
    return f"inline(array(named_struct({fields})))"
