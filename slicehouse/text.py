"""Quoting for the few statements that Spark takes as SQL text only."""

from __future__ import annotations

import datetime
import decimal


def name(identifier: str) -> str:
    """A possibly qualified Spark identifier in backquotes."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in identifier.split("."))


def column(identifier: str) -> str:
    """One Spark column in backquotes; a dot is part of its name."""
    return "`" + identifier.replace("`", "``") + "`"


def literal(value: object) -> str:
    """A Spark SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
