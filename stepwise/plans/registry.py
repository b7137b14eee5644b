"""All registered queries but those of the llm subpackage."""

from __future__ import annotations

import importlib

MODULES = ("caps", "corpora", "evaluate", "grading", "intervals", "ledgers", "match", "pairing", "pins", "pricing", "reconcile", "release", "scalars", "series", "signals", "sweep")


def collect(name: str) -> dict:
    out: dict = {}
    for module in MODULES:
        found = getattr(importlib.import_module(f"{__package__}.{module}"), name)
        if clash := out.keys() & found.keys():
            raise ValueError(f"registered twice: {sorted(clash)}")
        out |= found
    return out
