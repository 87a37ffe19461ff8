"""What Python workers do beside their work."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system.

    Workers outlive their tasks, and their allocators would hold what one task freed while the next one's grow.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)
