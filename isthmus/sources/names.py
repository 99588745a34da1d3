"""Remote names: parsing, quoting and making result columns unique."""

from __future__ import annotations

from dataclasses import dataclass


class BridgeError(ValueError):
    """A request that cannot be met, with the reason."""


class RemoteError(BridgeError):
    """What the remote side says, with its code."""

    def __init__(self, message: str, code: int) -> None:
        super().__init__(message)
        self.code = code


@dataclass(frozen=True)
class RemoteName:
    schema: str | None
    table: str


def parse_name(text: str) -> RemoteName:
    """T, S.T and quoted forms; unquoted parts are folded to upper case."""
    parts, i, n = [], 0, len(text)
    while True:
        if i < n and text[i] == '"':
            end = text.find('"', i + 1)
            if end <= i + 1:
                raise BridgeError(f"name {text!r}: empty or open quoted part")
            parts.append(text[i + 1 : end])
            i = end + 1
        else:
            end = text.find(".", i)
            end = n if end < 0 else end
            part = text[i:end]
            if not part or not (part[0].isalpha()) or not all(c.isalnum() or c in "_$#" for c in part):
                raise BridgeError(f"name {text!r}: {part!r} needs quotes")
            parts.append(part.upper())
            i = end
        if i == n:
            break
        if text[i] != "." or len(parts) == 2:
            raise BridgeError(f"name {text!r}: at most SCHEMA.TABLE")
        i += 1
    return RemoteName(parts[0] if len(parts) == 2 else None, parts[-1])


def quote(name: str) -> str:
    if '"' in name:
        raise BridgeError(f"name {name!r} holds a quote")
    return f'"{name}"'


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def unique_names(names: list[str]) -> list[str]:
    """Names made unique without regard to case by _1, _2, ... in column order, avoiding every given name."""
    given, used, out = {n.lower() for n in names}, set(), []
    for n in names:
        new, k = n, 0
        while new.lower() in used or (k and new.lower() in given):
            k += 1
            new = f"{n}_{k}"
        used.add(new.lower())
        out.append(new)
    return out
