"""Leading eigenpairs of a symmetric matrix by slicing its spectrum.

How many eigenvalues lie above a shift is read off the signs of the pivots of an LDL^T factorization of
the shifted matrix (Sylvester's law of inertia). Such counts bisect the spectrum until an interval holds
the wanted eigenvalue alone; Rayleigh quotient iteration, cubically convergent, then finds it with its
vector; and counts on both sides of the result certify its number. Eigenvalues that agree to working
precision share an interval: their vectors are an orthonormal basis of the space they have in common.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_EPS = float(np.finfo(float).eps)
_ALPHA = (1 + 17**0.5) / 8  # the bound on element growth of Bunch and Parlett's pivots


class Pair(NamedTuple):
    value: float
    vector: np.ndarray


class Uncertified(ArithmeticError):
    """The counts do not agree with the number of an eigenvalue."""


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: positive pivots of the LDL^T of the shifted matrix.

    Pivots are single diagonal entries or, where an entry off the diagonal is much larger, blocks of two,
    which have one positive and one negative eigenvalue.
    """
    rest = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(rest):
        diagonal = np.abs(np.diagonal(rest))
        r = int(diagonal.argmax())
        off = np.abs(np.triu(rest, 1))
        p, q = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[r] == 0 and off[p, q] == 0:
            break
        if diagonal[r] >= _ALPHA * off[p, q]:
            pivot, chosen = rest[r, r], [r]
            above += bool(pivot > 0)
        else:
            chosen = [int(p), int(q)]
            above += 1
        others = np.delete(np.arange(len(rest)), chosen)
        column = rest[np.ix_(others, chosen)]
        block = rest[np.ix_(chosen, chosen)]
        rest = rest[np.ix_(others, others)] - column @ np.linalg.solve(block, column.T)
        rest = (rest + rest.T) / 2
    return above


def _isolate(matrix: np.ndarray, number: int, low: float, high: float, least: float) -> tuple[float, float]:
    """Halve the interval until it holds eigenvalue ``number`` (from 1, falling) alone or is ``least`` wide."""
    below, beyond = count_above(matrix, low), count_above(matrix, high)
    while high - low > least and not (below == number and beyond == number - 1):
        middle = (low + high) / 2
        count = count_above(matrix, middle)
        if count >= number:
            low, below = middle, count
        else:
            high, beyond = middle, count
    return low, high


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray, nudge: float) -> np.ndarray:
    for _ in range(60):
        try:
            found = np.linalg.solve(matrix - shift * np.eye(len(matrix)), vector)
            if np.isfinite(found).all():
                return found
        except np.linalg.LinAlgError:
            pass
        shift, nudge = shift + nudge, nudge * 2
    raise Uncertified("a shifted matrix stays singular")


def _unit(vector: np.ndarray, found: list[Pair]) -> np.ndarray:
    for _ in range(2):  # once more for what rounding left
        for pair in found:
            vector = vector - (pair.vector @ vector) * pair.vector
        vector = vector / np.linalg.norm(vector)
    return vector


def leading_pairs(matrix: np.ndarray, k: int) -> list[Pair]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors whose largest entry is positive."""
    d = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max()) if d else 0.0
    tolerance = 16 * d * _EPS * bound
    found: list[Pair] = []
    for number in range(1, min(k, d) + 1):
        if bound == 0:
            found.append(Pair(0.0, np.eye(d)[number - 1]))
            continue
        low, high = -2 * bound, (min(found[-1].value + tolerance, 2 * bound) if found else 2 * bound)
        start = np.random.Generator(np.random.PCG64(number)).standard_normal(d)
        pair = None
        while pair is None:
            low, high = _isolate(matrix, number, low, high, tolerance / 4)
            pair = _iterate(matrix, start, low, high, found, tolerance)
            if pair is None:
                if high - low <= tolerance / 4:
                    raise Uncertified(f"eigenvalue {number} was not found between {low} and {high}")
                middle = (low + high) / 2
                low, high = (middle, high) if count_above(matrix, middle) >= number else (low, middle)
        if count_above(matrix, pair.value - tolerance) < number or count_above(matrix, pair.value + tolerance) >= number:
            raise Uncertified(f"the counts beside {pair.value} do not make it eigenvalue {number}")
        found.append(pair)
    return found


def _iterate(
    matrix: np.ndarray, start: np.ndarray, low: float, high: float, found: list[Pair], tolerance: float
) -> Pair | None:
    """Rayleigh quotient iteration from the middle of an interval; None if it leaves the interval."""
    middle, nudge = (low + high) / 2, _EPS * tolerance
    vector = _unit(start, found)
    for _ in range(3):
        vector = _unit(_solve(matrix, middle, vector, nudge), found)
    best = None
    for _ in range(12):
        value = float(vector @ matrix @ vector)
        if not low - tolerance <= value <= high + tolerance:
            return None
        residual = float(np.linalg.norm(matrix @ vector - value * vector))
        if best is not None and residual >= best[0]:
            break
        best = residual, value, vector
        vector = _unit(_solve(matrix, value, vector, nudge), found)
    if best is None or best[0] > tolerance:
        return None
    vector = best[2]
    return Pair(best[1], vector if vector[np.abs(vector).argmax()] > 0 else -vector)
