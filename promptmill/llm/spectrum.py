"""Leading eigenpairs of a symmetric matrix by slicing its spectrum with inertia counts.

The number of eigenvalues above a shift is the number of positive pivots of L D L^T of the shifted matrix. Halving a
bracket by such counts isolates the k-th largest eigenvalue, Rayleigh quotient iteration then converges cubically
inside the bracket, and counts on both sides of the result certify its number. Works on one matrix whose size is the
dimension of the vectors, not their number.
"""

from __future__ import annotations

import numpy as np

#: Balances the growth of 1 x 1 and 2 x 2 pivots.
_ALPHA = (1 + 17**0.5) / 8
_EPS = np.finfo(np.float64).eps


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed ``shift``: the positive inertia of ``matrix - shift * I``.

    L D L^T with complete symmetric pivoting; a 2 x 2 pivot is indefinite, so it has one eigenvalue of each sign.
    """
    work = matrix - shift * np.eye(len(matrix))
    positive, at, n = 0, 0, len(matrix)
    while at < n:
        rest = work[at:, at:]
        diagonal = np.abs(np.diagonal(rest))
        largest = int(diagonal.argmax())
        off = np.abs(rest - np.diag(np.diagonal(rest)))
        p, q = np.unravel_index(int(off.argmax()), off.shape)
        if off[p, q] == 0 and diagonal[largest] == 0:
            return positive
        if diagonal[largest] >= _ALPHA * off[p, q]:
            _swap(work, at, at + largest)
            pivot = work[at, at]
            positive += int(pivot > 0)
            column = work[at + 1 :, at].copy()
            work[at + 1 :, at + 1 :] -= np.outer(column, column / pivot)
            at += 1
        else:
            p, q = min(p, q), max(p, q)
            _swap(work, at, at + p)
            _swap(work, at + 1, at + q)
            block = work[at : at + 2, at : at + 2].copy()
            columns = work[at + 2 :, at : at + 2].copy()
            positive += 1
            work[at + 2 :, at + 2 :] -= columns @ np.linalg.solve(block, columns.T)
            at += 2
    return positive


def _swap(work: np.ndarray, i: int, j: int) -> None:
    if i != j:
        work[[i, j]] = work[[j, i]]
        work[:, [i, j]] = work[:, [j, i]]


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues above rounding, falling, and their unit eigenvectors as rows.

    The entry of largest size of a vector is positive (the first such). Equal eigenvalues give orthonormal vectors of
    their space. Fewer come back where the matrix has fewer positive eigenvalues.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max()) if n else 0.0
    if scale == 0:
        return np.zeros(0), np.zeros((0, n))
    tiny = max(n, 16) * _EPS * scale
    k = min(k, count_above(matrix, tiny))
    values, vectors = [], []
    for number in range(1, k + 1):
        value, vector = _pair(matrix, number, np.array(vectors).reshape(-1, n), tiny, scale)
        values.append(value)
        vectors.append(vector if vector[np.abs(vector).argmax()] > 0 else -vector)
    return np.array(values), np.array(vectors).reshape(-1, n)


def _pair(matrix: np.ndarray, number: int, found: np.ndarray, tiny: float, scale: float) -> tuple[float, np.ndarray]:
    """Eigenvalue ``number`` from above and a unit vector of it, orthogonal to those found."""
    low, high = 0.0, scale * (1 + _EPS * len(matrix))
    above_low, above_high = len(matrix), 0
    while True:
        isolated = above_low == number and above_high == number - 1
        if isolated or high - low <= tiny:
            settled = _iterate(matrix, low, high, found, tiny)
            if settled is not None:
                value, vector = settled
                # An eigenvalue alone within rounding must be this number by count; in a cluster any number of it will do.
                if count_above(matrix, value + tiny) < number <= count_above(matrix, value - tiny):
                    return value, vector
            if high - low <= tiny:
                raise ArithmeticError(f"eigenvalue {number} could not be certified")
        middle = (low + high) / 2
        above = count_above(matrix, middle)
        if above >= number:
            low, above_low = middle, above
        else:
            high, above_high = middle, above


def _iterate(matrix, low, high, found, tiny):
    """Rayleigh quotient iteration from the middle of a bracket; None if it leaves the bracket or does not settle."""
    n, shift = len(matrix), (low + high) / 2
    vector = _without(np.random.default_rng(len(found)).standard_normal(n), found)
    for step in range(60):
        try:
            solved = np.linalg.solve(matrix - shift * np.eye(n), vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            solved = np.linalg.solve(matrix - (shift + tiny / n) * np.eye(n), vector)
        vector = _without(solved, found)
        image = matrix @ vector
        value = float(vector @ image)
        residual = float(np.linalg.norm(image - value * vector))
        if residual <= tiny / 4:
            return (value, vector) if low - tiny <= value <= high + tiny else None
        if step >= 2:  # a few steps at the middle first, so that the quotient starts near
            if not low <= value <= high:
                return None
            shift = value
    return None


def _without(vector: np.ndarray, found: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector / np.linalg.norm(vector)
        vector = vector - found.T @ (found @ vector)
    return vector / np.linalg.norm(vector)
