"""One memo per Python worker: the one that was used last."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable


def memo(name: str, make: Callable[[], object]) -> object:
    """The worker's memo ``name``; made, and any other dropped, if it isn't the present one.  Workers
    are used again by later stages, which shouldn't carry the memos of earlier ones."""
    home = sys.modules.setdefault("_galley_worker", types.ModuleType("_galley_worker"))
    if home.__dict__.get("name") != name:
        home.__dict__["memo"] = None
        home.__dict__["memo"] = make()
        home.__dict__["name"] = name
    return home.__dict__["memo"]


def forget() -> None:
    """Drop the worker's memo."""
    memo("", dict)
