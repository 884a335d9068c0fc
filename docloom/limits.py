"""Limits of one parse, with the floor that an override cannot go below."""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import Any

KIB = 1024
MIB = 1024 * 1024

# Default and smallest allowed override of each limit.
DEFAULTS = {
    "max_input_bytes": (200 * MIB, MIB),
    "max_output_bytes": (8 * MIB, 64 * KIB),
    "timeout_secs": (600, 10),
    "max_archive_members": (512, 1),
    "max_archive_bytes": (512 * MIB, MIB),
    "max_jobs": (64, 4),
}
MAX_CONTENT_LIST_BYTES = 32 * MIB
MIN_TEXT_BYTES = 64 * KIB
KILL_GRACE_SECS = 5
LOG_TAIL_BYTES = 4000
LOG_TAIL_CHARS = 800


@dataclass(frozen=True)
class Limits:
    """The numbers an end-to-end job runs under.

    Operators take plain ints, so tests may pass values under the floors;
    ``from_overrides`` is the way operator-supplied settings come in.
    """

    max_input_bytes: int = DEFAULTS["max_input_bytes"][0]
    max_output_bytes: int = DEFAULTS["max_output_bytes"][0]
    timeout_secs: int = DEFAULTS["timeout_secs"][0]
    max_archive_members: int = DEFAULTS["max_archive_members"][0]
    max_archive_bytes: int = DEFAULTS["max_archive_bytes"][0]
    max_jobs: int = DEFAULTS["max_jobs"][0]
    min_text_bytes: int = MIN_TEXT_BYTES

    @classmethod
    def from_overrides(cls, overrides: dict[str, Any]) -> "Limits":
        """Unparsable values fall back to the default, small ones to the floor."""
        chosen = {}
        for f in fields(cls):
            if f.name not in DEFAULTS or f.name not in overrides:
                continue
            default, floor = DEFAULTS[f.name]
            try:
                chosen[f.name] = max(floor, int(str(overrides[f.name]).strip()))
            except ValueError:
                chosen[f.name] = default
        return cls(**chosen)
