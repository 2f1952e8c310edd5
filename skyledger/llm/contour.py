"""Leading eigenvectors of a symmetric matrix by contour integration.

The contour of an interval of eigenvalues is a circle in the complex plane. A quadrature of
shifted solves along it projects a block of vectors onto the eigenvectors inside, Rayleigh-Ritz
takes them out of the block, and counts of inertia at both ends tell how many there must be.
"""

from __future__ import annotations

import numpy as np

#: Nodes on the upper half of a circle; the lower half is their conjugate.
NODES = 8
#: Eigenvalues of an interval, unless they lie too close to be parted.
PER_INTERVAL = 8
SWEEPS = 12
_EPS = np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of an orthogonally similar tridiagonal matrix."""
    a = matrix.copy()
    n = len(a)
    off = np.zeros(max(n - 1, 0))
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        off[k] = length
        if length == 0 or not x[1:].any():
            off[k] = x[0]
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        q = p - (x @ p) * x
        rest -= 2 * (np.outer(x, q) + np.outer(q, x))
    if n > 1:
        off[n - 2] = a[n - 1, n - 2]
    return np.diag(a).copy(), off * off


class Inertia:
    """How many eigenvalues lie above a shift, by the signs of a factorisation (Sylvester)."""

    def __init__(self, matrix: np.ndarray):
        self._diagonal, self._squares = tridiagonal(matrix)
        self._least = max(np.abs(matrix).max(initial=0), 1e-300) * _EPS**2

    def above(self, shift: float) -> int:
        count, pivot = 0, 1.0
        for d, square in zip(self._diagonal, [0.0, *self._squares], strict=True):
            pivot = d - shift - square / pivot
            if abs(pivot) < self._least:
                pivot = -self._least
            count += pivot > 0
        return count


def intervals(
    inertia: Inertia, low: float, high: float, wanted: int
) -> list[tuple[float, float, int]]:
    """Parts of ``(low, high]`` from the top down with the eigenvalues in them, until ``wanted`` are
    covered. ``high`` has none above it."""
    result: list[tuple[float, float, int]] = []
    open_parts = [(low, high, inertia.above(low), inertia.above(high))]
    covered = 0
    while open_parts and covered < wanted:
        a, b, above_a, above_b = open_parts.pop()
        inside = above_a - above_b
        if not inside:
            continue
        middle = (a + b) / 2
        if inside <= PER_INTERVAL or not a < middle < b or b - a <= 1e-9 * max(abs(a), abs(b)):
            result.append((a, b, inside))
            covered += inside
            continue
        above_middle = inertia.above(middle)
        open_parts += [(a, middle, above_a, above_middle), (middle, b, above_middle, above_b)]
    return result


def _projected(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block, filtered to the eigenvectors of an interval."""
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    result = np.zeros_like(block)
    identity = np.eye(len(matrix))
    for point, weight in zip(points, weights, strict=True):
        turn = np.exp(1j * np.pi / 2 * (1 - point))
        solved = np.linalg.solve((centre + radius * turn) * identity - matrix, block)
        result += weight / 2 * (radius * turn * solved).real
    return result


def _ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    basis, _ = np.linalg.qr(block)
    small = basis.T @ (matrix @ basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return values, basis @ vectors


def eigenpairs_in(
    matrix: np.ndarray, low: float, high: float, inside: int, seed: int = 7
) -> np.ndarray:
    """The eigenvectors of an interval that holds ``inside`` eigenvalues, as columns.

    The block is half again as wide as it must be, and doubled where the count of accepted vectors
    does not reach ``inside``; as wide as the matrix it holds all of them.
    """
    n = len(matrix)
    random = np.random.default_rng(seed)
    width = min(n, inside + inside // 2 + 4)
    scale = np.abs(matrix).sum(axis=1).max()
    # a little wider, so that an eigenvalue at an end is inside on both sides of rounding
    margin = 16 * _EPS * scale + 0.05 * (high - low)
    while True:
        block = random.normal(size=(n, width))
        for _ in range(SWEEPS):
            values, block = _ritz(matrix, _projected(matrix, block, low - margin, high + margin))
            gaps = np.linalg.norm(matrix @ block - block * values, axis=0)
            good = gaps <= 8 * np.sqrt(n) * _EPS * scale
            if (good & (values > low) & (values <= high)).sum() == inside:
                return block[:, good & (values > low) & (values <= high)]
            near = np.abs(values - np.clip(values, low, high)) <= 16 * _EPS * scale
            if (good & near).sum() == inside:  # one at an end, by rounding
                return block[:, good & near]
        if width == n:
            # nothing is left to filter out: the block is the whole space
            order = np.argsort(np.abs(values - np.clip(values, low, high)), kind="stable")
            return block[:, order[:inside]]
        width = min(n, 2 * width)


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above rounding, falling, and unit eigenvectors as rows.

    The entry of a vector with the largest absolute value is positive. A matrix of lower rank has
    fewer.
    """
    n = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max(initial=0)
    zero = max(np.trace(matrix) * n * _EPS, 0.0)
    if not n or not np.isfinite(scale) or scale <= 0:
        return np.zeros(0), np.zeros((0, n))
    inertia = Inertia(matrix)
    wanted = min(wanted, inertia.above(zero))
    if not wanted:
        return np.zeros(0), np.zeros((0, n))
    parts = [
        eigenpairs_in(matrix, low, high, inside)
        for low, high, inside in intervals(inertia, zero, scale * (1 + 1e-6), wanted)
    ]
    # once more over all intervals, so that vectors of different ones are orthogonal to rounding
    values, vectors = _ritz(matrix, np.concatenate(parts, axis=1))
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = vectors[:, order].T
    largest = np.abs(vectors).argmax(axis=1)
    vectors *= np.sign(vectors[np.arange(len(vectors)), largest])[:, None]
    return values[order], vectors
