"""Arrow batches cut to a bounded number of rows and text bytes, for operators that work in Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_ROWS = 512
PART_BYTES = 4 << 20


def parts(batches: Iterator[pa.RecordBatch], text: int, rows: int = PART_ROWS, size: int = PART_BYTES) -> Iterator[list[pa.Array]]:
    """The batches' columns in parts of at most ``rows`` rows and about ``size`` bytes of text; a longer text is alone.

    The text column comes as large strings without NULLs. Parts are copies with no offset into their batch: string
    functions of some Arrow versions read a sliced array from its buffer's start. Between parts Arrow returns the memory
    it no longer uses: a worker lives on from task to task, and what it keeps adds to the executor's memory.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > first and (i - first >= rows or held + n > size):
                yield part(batch, text, first, i)
                pa.default_memory_pool().release_unused()
                first, held = i, 0
            held += n
        if batch.num_rows:
            yield part(batch, text, first, batch.num_rows)
            pa.default_memory_pool().release_unused()


def part(batch: pa.RecordBatch, text: int, first: int, end: int) -> list[pa.Array]:
    places = pa.array(np.arange(first, end))
    columns = [pc.take(c, places) for c in batch.columns]
    columns[text] = pc.fill_null(columns[text], "").cast(pa.large_string())
    return columns
