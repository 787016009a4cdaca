"""Whole groups from sorted Arrow batches, and component labels within a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class Labels:
    """Components of row numbers within a task: the label is the smallest number of the component."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            la, lb = label[a], label[b]
            if (la == lb).all():
                return
            low, high = np.minimum(la, lb), np.maximum(la, lb)
            np.minimum.at(label, high, low)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def whole_groups(batches, rows: int, group: str = "grp", most_bytes: int = 1 << 62):
    """Tables of about ``rows`` rows or ``most_bytes`` bytes, cut between groups; the input is sorted by group."""
    held, n = [], 0
    for b in batches:
        held.append(pa.Table.from_batches([b]))
        n += b.num_rows
        if n < rows and sum(t.nbytes for t in held) < most_bytes:
            continue
        table = pa.concat_tables(held).combine_chunks()
        values = table.column(group).to_numpy()
        cut = int(np.searchsorted(values, values[-1]))
        if cut:
            yield table.slice(0, cut)
        held, n = [table.slice(cut)], table.num_rows - cut
    if n:
        yield pa.concat_tables(held).combine_chunks()
