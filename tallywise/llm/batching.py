"""How many rows travel to a Python worker at once, and what a worker gives back when its task ends."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of an Arrow batch: texts are long, and a worker holds a batch several times over.
ROWS = 500
SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batch size to ``ROWS``, unless it is lower already; results do not depend on it."""
    now = int(spark.conf.get(SETTING, "10000"))
    if now <= 0 or now > ROWS:
        spark.conf.set(SETTING, str(ROWS))


def beside(run: Callable, column: str, keep: list[str], names: list[str]) -> Callable:
    """A function for ``mapInArrow`` that puts what ``run`` makes of one column's values beside other columns.

    ``run`` takes the values as a list and returns one list or array per name. The columns of ``keep`` are passed on as
    they came, never as Python or pandas values, so integers of any size stay what they are beside a null.
    """
    def work(batches):
        for batch in batches:
            made = run(batch.column(column).to_pylist())
            arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in made]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], *arrays], [*keep, *names])

    return trimmed(work)


def trimmed(run: Callable) -> Callable:
    """A function for ``mapInPandas`` that returns freed memory to the system when its task ends.

    Workers outlive their tasks, and what the allocators keep would count against the executor in later stages.
    """
    def work(frames):
        yield from run(frames)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
        if trim is not None:
            trim(0)

    return work
