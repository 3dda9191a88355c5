"""Eigenpairs of a symmetric matrix inside an interval, by contour integration (FEAST).

The matrix is dimensions x dimensions, so its size does not follow the number of rows it was computed from.  The projector
onto the eigenvectors whose values lie inside a circle is a contour integral of the resolvent; quadrature turns it into a
few solves with complex shifts, Rayleigh-Ritz on the filtered subspace gives the pairs, and this is repeated until the
residual is at the level of rounding.  How many pairs there must be is known from the inertia of the shifted matrix
(signs of the pivots of its LDL^T factors), so none can be missed unnoticed.
"""

from __future__ import annotations

import numpy as np

#: Quadrature nodes on the half circle, most refinements, and eigenvalues beyond the wanted ones that an interval may hold.
NODES, MOST_ROUNDS, SPARE = 8, 40, 4
#: Eigenvalues below this share of the greatest count as zero.
NO_VARIANCE = 1e-12


def positive_count(matrix: np.ndarray) -> int:
    """Number of positive eigenvalues: the signs of an LDL^T factorisation with pivots of one or two rows."""
    a, positive = np.array(matrix, float), 0
    ratio = (1 + 17**0.5) / 8  # bounds the growth of the entries
    while a.size:
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a) - np.diag(diagonal)
        q, r = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[p] >= ratio * off[q, r]:
            if diagonal[p] == 0:
                return positive  # what is left is zero
            pivot = [p]
            positive += a[p, p] > 0
        else:
            pivot = [int(q), int(r)]
            positive += 1  # such a block has one positive and one negative eigenvalue
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        columns = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_(pivot, pivot)], columns.T)
    return int(positive)


def above(matrix: np.ndarray, bound: float) -> int:
    """Number of eigenvalues above a bound."""
    return positive_count(matrix - bound * np.eye(len(matrix)))


def interval_of_greatest(matrix: np.ndarray, wanted: int) -> tuple[float, float, int]:
    """(low, high, count): an interval that holds all eigenvalues above ``low``, at least ``wanted`` of them if there are.

    Bisection with inertia counts; it stops when few more than the wanted ones are inside.  Values that lie too close
    to be told apart stay in the interval together.
    """
    high = float(np.abs(matrix).sum(axis=1).max()) * 1.01  # no eigenvalue passes the greatest row sum
    floor = NO_VARIANCE * high
    count = above(matrix, floor)
    wanted = min(wanted, count)
    if wanted == 0:
        return high, high, 0
    low, top = floor, high
    while count > wanted + SPARE and top - low > floor:
        middle = (low + top) / 2
        inside = above(matrix, middle)
        low, top, count = (middle, top, inside) if inside >= wanted else (low, middle, count)
    bottom = low
    while high - bottom > 0.1 * high:  # a tight upper end makes the circle small
        middle = (bottom + high) / 2
        bottom, high = (middle, high) if above(matrix, middle) else (bottom, middle)
    return low, high, count


def inside(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in (low, high], falling, and their unit eigenvectors as columns."""
    d = len(matrix)
    x, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi / 2 * (1 - x))
    centre, radius = (low + high) / 2, (high - low) / 2
    shifted = [(centre + radius * t) * np.eye(d) - matrix for t in turn]
    width, scale = min(d, count + max(4, count // 2)), float(np.abs(matrix).max())
    rng = np.random.default_rng(7)
    basis, best, stuck = rng.standard_normal((d, width)), np.inf, 0
    values = vectors = None
    for _ in range(MOST_ROUNDS):
        filtered = sum(
            w / 2 * (radius * t * np.linalg.solve(z, basis.astype(complex))).real for w, t, z in zip(weights, turn, shifted)
        )
        q, _ = np.linalg.qr(filtered)
        ritz, inner = np.linalg.eigh(q.T @ matrix @ q)
        basis = q @ inner
        found = np.flatnonzero((ritz > low) & (ritz <= high))[::-1]
        if len(found) != count:
            continue
        residual = float(np.linalg.norm(matrix @ basis[:, found] - basis[:, found] * ritz[found], axis=0).max())
        stuck = 0 if residual < best / 2 else stuck + 1
        if residual < best:
            best, values, vectors = residual, ritz[found], basis[:, found]
        if stuck >= 2 and best <= 1e-10 * scale:
            return values, vectors / np.linalg.norm(vectors, axis=0)
    if values is None or best > 1e-10 * scale:
        raise ArithmeticError(f"{count} eigenvalues between {low} and {high}, but they were not all found")
    return values, vectors / np.linalg.norm(vectors, axis=0)


def greatest(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues of a positive semidefinite matrix, falling, with unit eigenvectors as columns.

    Eigenvalues that count as zero are left out.
    """
    if not matrix.size:
        return np.zeros(0), np.zeros((0, 0))
    low, high, count = interval_of_greatest(matrix, wanted)
    if not count:
        return np.zeros(0), np.zeros((len(matrix), 0))
    values, vectors = inside(matrix, low, high, count)
    return values[:wanted], vectors[:, :wanted]
