"""The pseudonymisation switch of a run."""
from __future__ import annotations

# The only texts that turn pseudonymisation off.
FALSE_TOKENS = ("false", "0", "no")


def pseudonymize_enabled(flag: str | bool | None) -> bool:
    """Protective default: anything but an explicit false keeps hashing on."""
    return str(flag).strip().lower() not in FALSE_TOKENS
