"""Arrow batches in pieces that a task turns into arrays at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def slices(batch, sizes: np.ndarray, limit: int) -> Iterator:
    """``batch`` in runs of rows of about ``limit``; ``sizes`` are those of its rows. A larger row is taken alone."""
    till, begin = np.cumsum(sizes), 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(till, (till[begin - 1] if begin else 0) + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end
