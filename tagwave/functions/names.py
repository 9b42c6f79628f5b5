"""Header cleaning: snake-case names, repeated names numbered."""

from __future__ import annotations

import re

_BORDER = re.compile(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def snake_name(name: str) -> str:
    """``DeployID`` -> ``deploy_id``, ``FastGPS Power`` -> ``fast_gps_power``,
    ``Byte #0`` -> ``byte_0``: words begin at a change of case or after
    anything but letters and digits; digits stay with the letters before them."""
    words = [w for part in re.split(r"[^0-9A-Za-z]+", name) for w in _BORDER.split(part) if w]
    out = "_".join(words).lower()
    return f"x{out}" if re.match(r"[0-9]|$", out) else out


def snake_names(header: list[str]) -> list[str]:
    """Snake-case names of a header; the second, third, ... of equal names get
    ``_2``, ``_3``, ..."""
    seen: dict[str, int] = {}
    out = []
    for h in header:
        name = snake_name(h)
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out
