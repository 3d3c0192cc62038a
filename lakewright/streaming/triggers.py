"""Trigger names as jobs spell them."""

from __future__ import annotations

DEFAULT_INTERVAL = "4 hours"


def trigger_options(name: str = "ProcessingTime", interval: str | None = None) -> dict:
    """Keyword arguments for ``DataStreamWriter.trigger``."""
    if name == "ProcessingTime":
        return {"processingTime": interval or DEFAULT_INTERVAL}
    if name == "AvailableNow":
        return {"availableNow": True}
    if name == "Continuous":
        raise ValueError("Continuous is not possible: file and table sources run in micro-batches only")
    raise ValueError(f"unknown trigger {name!r}; use ProcessingTime or AvailableNow")
