"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST).

The spectral projector onto the eigenvalues inside a circle is the contour
integral of the resolvent; a quadrature turns it into a few complex shifted
solves.  Applying it to a block of vectors keeps what belongs to the interval,
Rayleigh-Ritz on the block gives eigenpairs, and repeating both sharpens them.
How many eigenvalues an interval holds is known beforehand from the inertia of
the shifted matrix (Sylvester), so a missing one is noticed: the block is then
widened, in the end to the whole space.

The matrix is dense and small (dimensions squared); it never grows with rows.
"""

from __future__ import annotations

import numpy as np

#: Quadrature nodes on the upper half circle.
NODES = 8
#: Eigenvalues that one interval should hold.
PER_INTERVAL = 4
_EPS = np.finfo(float).eps
_TINY = 1e-290


class Inertia:
    """Counts of eigenvalues above a shift: the positive pivots of the shifted
    matrix, which a change of basis leaves as they are.  The matrix becomes
    tridiagonal once, by reflections; a count is then one pass over it."""

    def __init__(self, matrix: np.ndarray):
        a = np.array(matrix, float)
        d = len(a)
        off = np.zeros(max(d - 1, 0))
        for k in range(d - 2):
            x = a[k + 1:, k].copy()
            length = np.linalg.norm(x)
            off[k] = -np.copysign(length, x[0])
            if length == 0:
                continue
            x[0] -= off[k]
            x /= np.linalg.norm(x)
            rest = a[k + 1:, k + 1:]
            w = rest @ x
            w -= x * (x @ w)
            rest -= 2 * (np.outer(x, w) + np.outer(w, x))
        if d > 1:
            off[-1] = a[-1, -2]
        self.diagonal, self.squares = np.diag(a).tolist(), [0.0, *(off * off).tolist()]

    def above(self, shift: float) -> int:
        n, pivot = 0, 1.0
        for x, square in zip(self.diagonal, self.squares):
            pivot = x - shift - square / pivot
            if pivot == 0:
                pivot = -_TINY
            n += pivot > 0
        return n


def edge_below(count, wanted: int, low: float, high: float, width: float) -> tuple[float, int]:
    """A place with ``wanted`` eigenvalues above it, in the middle of the gap
    that it lies in, and their number; where the next eigenvalue is equal to
    ``width``, the place below all of these."""
    bottom, top = low, high
    n = count(low)
    if n <= wanted:
        return low, n
    place, above = low, n
    while top - bottom > width:
        middle = (bottom + top) / 2
        n = count(middle)
        if n >= wanted:
            place, above, bottom = middle, n, middle
            if n == wanted:
                break
        else:
            top = middle
    lowest, highest = place, place
    step_low, step_high = low, high
    for _ in range(12):  # to the ends of the gap, nearly
        down, up = (step_low + lowest) / 2, (step_high + highest) / 2
        if count(down) == above:
            lowest = down
        else:
            step_low = down
        if count(up) == above:
            highest = up
        else:
            step_high = up
    return (lowest + highest) / 2, above


def _project(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's part that belongs to eigenvalues in the interval."""
    centre, radius = (low + high) / 2, (high - low) / 2
    places, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * (np.pi / 2) * (1 - places))
    out = np.zeros_like(block)
    for t, w in zip(turn, weights):
        solved = np.linalg.solve((centre + radius * t) * np.eye(len(matrix)) - matrix, block.astype(complex))
        out += (w / 2) * (radius * t * solved).real
    return out


def _ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    basis, _ = np.linalg.qr(block)
    basis, _ = np.linalg.qr(basis)
    small = basis.T @ matrix @ basis
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values, basis @ turn


def interval_pairs(matrix: np.ndarray, low: float, high: float, inside: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``inside`` eigenpairs of the interval."""
    d = len(matrix)
    size = min(d, inside + max(inside, 4))
    scale = max(abs(low), abs(high), _EPS)
    norm = np.linalg.norm(matrix, 2) if d <= 64 else np.linalg.norm(matrix)
    enough = 16 * _EPS * max(norm, scale)
    while True:
        block = np.random.default_rng(seed).standard_normal((d, size))
        best = np.inf
        for _ in range(40):
            values, vectors = _ritz(matrix, _project(matrix, block, low, high))
            within = (values > low) & (values <= high)
            if within.sum() == inside:
                residual = np.linalg.norm(matrix @ vectors[:, within] - vectors[:, within] * values[within], axis=0).max()
                # converged, or as far as rounding goes
                if residual <= enough or (residual > best / 2 and best <= 1e3 * enough):
                    return values[within], vectors[:, within]
                best = min(best, residual)
            block = vectors
        if size == d:
            raise ArithmeticError(f"{inside} eigenvalues counted in ({low}, {high}], {int(within.sum())} found")
        size = min(d, 2 * size)


def largest_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``wanted`` largest positive eigenvalues, falling, and their unit
    vectors as columns.  Eigenvalues that rounding can't tell from zero don't
    count as positive."""
    d = len(matrix)
    top = float(np.abs(matrix).sum(1).max()) if d else 0.0
    if not top:
        return np.zeros(0), np.zeros((d, 0))
    scaled = matrix / top
    zero = 4 * d * _EPS
    inertia, known = Inertia(scaled), {}

    def count(shift: float) -> int:
        if shift not in known:
            known[shift] = inertia.above(shift)
        return known[shift]

    high = 1 + 1e-3  # no eigenvalue lies above the largest absolute row sum
    wanted = min(wanted, count(zero))
    values, vectors, found = [], [], 0
    while found < wanted:
        low, above = edge_below(count, min(found + PER_INTERVAL, wanted), zero, high, zero)
        if above > found:
            e, v = interval_pairs(scaled, low, high, above - found)
            values.append(e)
            vectors.append(v)
        found, high = above, low
    if not values:
        return np.zeros(0), np.zeros((d, 0))
    # once more over all intervals, which makes neighbours exactly orthogonal
    e, v = _ritz(scaled, np.hstack(vectors))
    order = np.argsort(-e)[:wanted]
    return e[order] * top, v[:, order]
