"""Token-byte and token-group incidence matrices in CSR form, and their products row by row."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rows:
    """Row i of a 0/1 matrix has ones in the columns ``columns[starts[i]:starts[i + 1]]``, ascending."""

    starts: np.ndarray
    columns: np.ndarray

    @classmethod
    def of_runs(cls, lengths: np.ndarray) -> Rows:
        """Row i covers the next ``lengths[i]`` columns: tokens by the bytes they cover."""
        starts = np.concatenate([[0], np.cumsum(lengths)])
        return cls(starts, np.arange(starts[-1], dtype=np.int32))

    @classmethod
    def of_labels(cls, labels: np.ndarray) -> Rows:
        """Row i has a single one, in column ``labels[i]``."""
        return cls(np.arange(len(labels) + 1), labels)

    def transposed(self, columns: int) -> Rows:
        """The same matrix by columns; rows stay in order within each."""
        rows = np.repeat(np.arange(len(self.starts) - 1, dtype=np.int32), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        sizes = np.bincount(self.columns, minlength=columns)
        return Rows(np.concatenate([[0], np.cumsum(sizes)]), rows[order])


def terms(a: Rows, b: Rows) -> np.ndarray:
    """How many terms each one of ``a`` contributes to the product: the size of the row of ``b`` it meets.

    Where every row of ``a`` has one one, these are the sizes of the product's rows, without making them.
    """
    return np.diff(b.starts)[a.columns]


def product(a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the non-zero elements of a x b, ascending, after Gustavson.

    Row i is the sum of the rows of ``b`` that the ones of row i of ``a`` name.  Where these come with
    ascending columns, as tokens over bytes do, equal neighbours are added up without sorting.
    """
    reach = terms(a, b)
    ends = np.cumsum(reach)
    total = int(ends[-1]) if len(ends) else 0
    row = np.repeat(np.repeat(np.arange(len(a.starts) - 1, dtype=np.int32), np.diff(a.starts)), reach)
    column = b.columns[np.repeat(b.starts[:-1][a.columns] - (ends - reach), reach) + np.arange(total)]
    if np.any((row[1:] == row[:-1]) & (column[1:] < column[:-1])):
        order = np.lexsort((column, row))
        row, column = row[order], column[order]
    first = np.ones(total, bool)
    first[1:] = (row[1:] != row[:-1]) | (column[1:] != column[:-1])
    at = np.flatnonzero(first)
    return row[at], column[at], np.diff(np.append(at, total))
