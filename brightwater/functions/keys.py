"""Keys of scored payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_HEX = 16


def payload_json(columns: list[str]) -> Column:
    """The named columns as JSON text, fields sorted by name, nulls written out."""
    fields = []
    for name in sorted(columns):
        # A one-element array gives JSON quoting and escaping for any type.
        listed = F.to_json(F.array(F.col(name)), {"ignoreNullFields": "false"})
        value = F.when(F.col(name).isNull(), "null").otherwise(_inner(listed))
        fields.append(F.concat(F.lit(f'"{name}": '), value))
    return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))


def _inner(listed: Column) -> Column:
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def score_key(prefix: str, columns: list[str]) -> Column:
    """``prefix:`` and the first 16 hex digits of the payload's SHA-256.

    The order in which columns are named does not matter.
    """
    return F.concat(F.lit(f"{prefix}:"), F.substring(F.sha2(payload_json(columns), 256), 1, KEY_HEX))


def glob_regex(pattern: str) -> str:
    """A key glob (``*``, ``?``, ``[a-c]``, ``[^x]``, ``\\`` escapes) as a regular expression."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        close = pattern.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out.append("[\\s\\S]*")
        elif c == "?":
            out.append("[\\s\\S]")
        elif c == "[" and close > 0:
            inner = pattern[i + 1 : close]
            negated, inner = inner.startswith("^"), inner.removeprefix("^")
            safe = inner.replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&").replace("^", "\\^")
            out.append(f"[{'^' if negated else ''}{safe}]")
            i = close
        elif c == "\\" and i + 1 < len(pattern):
            i += 1
            out.append(_quote(pattern[i]))
        else:
            out.append(_quote(c))
        i += 1
    return f"^{''.join(out)}$"


def _quote(c: str) -> str:
    return c if c.isalnum() or c in "_:- " else f"\\{c}"
