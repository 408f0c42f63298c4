"""What Python tasks of this subpackage share: shipping of code, and a cache per worker process."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle


def travels(module: str) -> None:
    """Send the functions of a module inside the task, so that executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def process_cache() -> dict[Any, Any]:
    """A dict that lives as long as the Python worker process, across its tasks.

    Code that travels with a task is unpickled once per task; what is costly to build
    (a tokenizer's tables) is kept here by content instead.
    """
    return sys.modules.setdefault("pagemill_worker_cache", ModuleType("pagemill_worker_cache")).__dict__


def beside(columns: list[str], taken: list[str]) -> list[str]:
    """The columns whose names none of `taken` claims; Spark does not tell cases apart."""
    names = {c.lower() for c in taken}
    return [c for c in columns if c.lower() not in names]


#: Bytes of text that Arrow kernels are given at a time.
PORTION = 1 << 22


def portions(batch: pa.RecordBatch, column: str, size: int = PORTION) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `size` bytes of a text column; a longer text is a slice of its own."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(batch):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + size, "right")))
        yield batch.slice(at, end - at)
        at = end


travels(__name__)
