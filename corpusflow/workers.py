"""Functions for Python workers."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle


def ship_by_value(module: str) -> None:
    """Send the module's functions to the workers themselves, not their names.

    Executors then run them without a copy of this package on their path.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def trim() -> None:
    """Give free memory back to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        # Another C library: it keeps what it keeps.
        pass


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of mapInArrow that gives its free memory back when a task ends.

    Workers outlive their task, and what they keep would be missing for the stages that follow.
    """

    def done(batches: Iterator) -> Iterator:
        yield from run(batches)
        trim()

    return done


ship_by_value(__name__)
