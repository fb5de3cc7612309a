"""Values of JSON payloads as text, for the one pass over payload files that runs in Python."""

from __future__ import annotations

import hashlib
import json
from typing import Any

# values of parsed JSON hold no circles, so none are looked for
_compact = json.JSONEncoder(sort_keys=True, separators=(",", ":"), default=str, check_circular=False).encode
_sorted = json.JSONEncoder(sort_keys=True, default=str, check_circular=False).encode


def compact(value: Any) -> str:
    """JSON text with sorted keys and no spaces: equal content has equal text."""
    return _compact(value)


def structure(value: Any) -> Any:
    """What a text delimited by braces or brackets holds, if it is JSON; every other value as it is."""
    if isinstance(value, str):
        if value[:1].isalnum():  # as most are; neither a bracket nor white space before one
            return value
        text = value.strip()
        if len(text) > 1 and text[0] + text[-1] in ("{}", "[]", "{]", "[}"):
            try:
                return json.loads(text)
            except ValueError:
                pass
    return value


def records(value: Any) -> list[dict]:
    """The objects of an array, or the one object, native or as text; nothing of all else."""
    value = structure(value)
    items = [value] if isinstance(value, dict) else value if isinstance(value, list) else []
    return [x for x in map(structure, items) if isinstance(x, dict)]


def text_of(value: Any) -> str | None:
    """A value for a text column: texts as they are, structure as compact JSON, true and false in lower case."""
    value = structure(value)
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, (dict, list)):
        return compact(value)
    return str(value).lower() if isinstance(value, bool) else str(value)


def content_hash(business: dict[str, str | None]) -> str:
    """SHA-256 over the business values by column, whatever their order; an absent value differs from a null one."""
    return hashlib.sha256(_sorted(business).encode()).hexdigest()
