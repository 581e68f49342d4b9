"""Text helpers."""

from __future__ import annotations

# Every control character up to and including the space, as SQL escapes.
BLANKS = "".join(f"\\u{code:04x}" for code in range(0x21))


def strip(text: str) -> str:
    return f"trim(BOTH '{BLANKS}' FROM {text})"


def literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
