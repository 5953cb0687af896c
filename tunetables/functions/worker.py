"""What a Python worker keeps between tasks."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any


def kept_by_worker(name: str, key: str, make: Callable[[], Any]) -> Any:
    """The object made under ``key``, once for as long as the Python worker lives.

    Functions of this package reach workers by value, so their modules can't hold state there.
    One object is kept for each ``name``: another key takes its place.
    """
    module = sys.modules.setdefault("_tunetables_kept", types.ModuleType("_tunetables_kept"))
    held = module.__dict__.get(name)
    if held is None or held[0] != key:
        held = module.__dict__[name] = (key, make())
    return held[1]
