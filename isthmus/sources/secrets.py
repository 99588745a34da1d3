"""Credentials by name, outside of plans and options, and never shown."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from isthmus.sources.names import BridgeError


@dataclass(frozen=True)
class Secret:
    user: str
    password: str = field(repr=False)
    dsn: str = ""


_KNOWN: dict[str, Secret] = {}


def create_secret(name: str, user: str, password: str, dsn: str, replace: bool = False) -> None:
    if not (user and password and dsn):
        raise BridgeError("a secret needs user, password and dsn")
    if name in _KNOWN and not replace:
        raise BridgeError(f"secret {name!r} exists")
    _KNOWN[name] = Secret(user, password, dsn)


def secret(name: str) -> Secret:
    if name not in _KNOWN:
        raise BridgeError(f"no secret {name!r}")
    return _KNOWN[name]


def drop_secret(name: str) -> None:
    _KNOWN.pop(name, None)


def redacted(text: str) -> str:
    """text without any known password, and without what follows password=."""
    for s in sorted(_KNOWN.values(), key=lambda s: -len(s.password)):
        text = text.replace(s.password, "***")
    return re.sub(r"(?i)(password\s*[=:]\s*)\S+", r"\1***", text)
