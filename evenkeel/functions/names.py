"""Names that may be placed into SQL text."""

from __future__ import annotations

import re

from evenkeel.errors import ConfigError
from evenkeel.spec import IDENTIFIER_PATTERN

_IDENTIFIER = re.compile(IDENTIFIER_PATTERN)


def safe_name(name: str, kind: str = "identifier") -> str:
    if not isinstance(name, str) or not _IDENTIFIER.fullmatch(name):
        raise ConfigError(f"invalid {kind}: {name!r}")
    return name


def qualified(*parts: str) -> str:
    return ".".join(safe_name(p) for p in parts)
