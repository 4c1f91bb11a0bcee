"""Reading sorted Arrow batches run by run, inside a task."""

import numpy as np
import pyarrow as pa


def _same(left, right):
    """Rows at which two equally long lists of columns agree."""
    same = np.ones(len(left[0]), bool)
    for a, b in zip(left, right):
        if pa.types.is_binary(a.type) or pa.types.is_string(a.type):
            import pyarrow.compute as pc

            same &= pc.equal(a, b).to_numpy(zero_copy_only=False)
        else:
            same &= a.to_numpy(zero_copy_only=False) == b.to_numpy(zero_copy_only=False)
    return same


def changes(table, keys):
    """First rows of the runs of equal keys in a sorted batch."""
    columns = [table.column(k) for k in keys]
    n = table.num_rows
    if n < 2:
        return np.arange(n)
    same = _same([c.slice(1) for c in columns], [c.slice(0, n - 1) for c in columns])
    return np.concatenate([[0], np.flatnonzero(~same) + 1])


def whole_runs(batches, keys):
    """Record batches, cut so that no run of equal keys is spread over two of them.

    One run and one batch are held at a time.
    """
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        first = changes(batch, keys)
        if held:
            joint = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)]).combine_chunks()
            if len(changes(joint.to_batches()[0], keys)) == 2:
                yield joined(held)
                held = []
        last = int(first[-1])
        if last:
            yield joined([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield joined(held)


def joined(held):
    if len(held) == 1:
        return held[0]
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def fixed_binary(column, dtype, width):
    """A binary column whose values all have `width` items, as a matrix."""
    _, ends, data = column.buffers()
    item = np.dtype(dtype).itemsize
    first = np.frombuffer(ends, np.int32)[column.offset] if len(column) else 0
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[first : first + len(column) * width * item].view(dtype).reshape(len(column), width)
