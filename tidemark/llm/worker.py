"""What a Python worker keeps from one task to the next."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def of_worker(key: str, make: Callable[[], Any]) -> Any:
    """The worker's object of this key; made at the first use, found again by later tasks of the worker."""
    state = vars(sys.modules.setdefault("_worker_objects", types.ModuleType("_worker_objects")))
    if key not in state:
        state[key] = make()
    return state[key]
