"""Column-name canonicalisation (driver-side metadata, no row work)."""

from __future__ import annotations

# Characters with a spelling of their own in canonical headers.
_SPELLINGS = {"%": "_pct", ")": ""}


def normalize_name(header: str) -> str:
    """``" Wage (EUR) "`` -> ``wage_eur``, ``Win%`` -> ``win_pct``, ``x(y)z`` -> ``x_yz``."""
    spelled = (
        _SPELLINGS.get(ch, ch if ch.isalnum() else "_") for ch in header.strip().lower()
    )
    return "_".join(filter(None, "".join(spelled).split("_")))
