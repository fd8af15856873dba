"""What operators on vectors share inside tasks."""

from __future__ import annotations

# Whole numbers up to this are exact as doubles.
EXACT = 2.0**53
LONG = 2**63 - 1


def padded(column, width: int | None = None):
    """A matrix of doubles from an Arrow column of lists without nulls; short ones end in zeros."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0)) if width is None else width
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def whole(matrix):
    """The same whole numbers as Python integers."""
    import numpy as np

    return np.array([[int(x) for x in row] for row in matrix], dtype=object).reshape(matrix.shape)
