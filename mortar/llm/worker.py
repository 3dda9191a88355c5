"""What a Python worker keeps between tasks: one object at most, whatever operators ran in it before."""

from __future__ import annotations

import gc
from collections.abc import Callable
from typing import Any

_HELD: dict[str, Any] = {}


def held(token: str, make: Callable[[], Any]) -> Any:
    """The object of this token, made on first use; that of any other token is let go before."""
    if token not in _HELD:
        _HELD.clear()
        gc.collect()  # automata refer to themselves
        _HELD[token] = make()
    return _HELD[token]
