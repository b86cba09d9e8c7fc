"""Trying again with growing waits."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

R = TypeVar("R")


def with_retry(run: Callable[[], R], tries: int = 5, first: float = 1.0, most: float = 30.0, again: Callable[[Exception], bool] = lambda e: True, sleep: Callable[[float], None] = time.sleep) -> R:
    """The result of ``run``; after an error that ``again`` accepts it waits, twice as long each time, up to ``most`` seconds."""
    wait = first
    for n in range(1, tries + 1):
        try:
            return run()
        except Exception as e:
            if n == tries or not again(e):
                raise
            sleep(wait)
            wait = min(wait * 2, most)
    raise ValueError("at least one try is needed")
