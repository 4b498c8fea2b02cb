"""Steps of the smoother that can be put together in any grouping.

A row of steps acts on a state as one element (a, b, c, eta, j): from mean m and
covariance p it leads to mean a (1 + p j)^-1 (m + p eta) + b and covariance
a (1 + p j)^-1 p a' + c. Two elements in a row are again one, so a long run can
be cut into pieces that are reduced at the same time. The form is that of
parallel filtering by associative scans (Sarkka and Garcia-Fernandez, 2021).

All arrays hold one 2 x 2 matrix for each element; b and eta have a column for
east and one for north, which share all else.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Elements(NamedTuple):
    a: np.ndarray
    b: np.ndarray
    c: np.ndarray
    eta: np.ndarray
    j: np.ndarray

    def __len__(self) -> int:  # the number of elements, not of fields
        return self.a.shape[0]

    def take(self, which: slice) -> Elements:
        return Elements(self.a[which], self.b[which], self.c[which], self.eta[which], self.j[which])


def joined(parts: list[Elements]) -> Elements:
    return Elements(*(np.concatenate([getattr(p, f) for p in parts]) for f in Elements._fields))


def fixed(mean: np.ndarray, covariance: np.ndarray) -> Elements:
    """One element that leads to a state whatever came before."""
    zero = np.zeros((1, 2, 2))
    return Elements(zero, mean[None], covariance[None], zero, zero)


def steps(dt: np.ndarray, x: np.ndarray, y: np.ndarray, at_rest: np.ndarray, measurement: float, acceleration: float, drift: float) -> Elements:
    """An element for each ping, from the ping before it."""
    f, q = np.zeros((len(dt), 2, 2)), np.zeros((len(dt), 2, 2))
    moving = ~at_rest
    f[:, 0, 0], f[:, 0, 1], f[:, 1, 1] = 1.0, np.where(moving, dt, 0.0), moving
    q[:, 0, 0] = np.where(moving, acceleration * dt**4 / 4, drift)
    q[:, 0, 1] = q[:, 1, 0] = np.where(moving, acceleration * dt**3 / 2, 0.0)
    q[:, 1, 1] = np.where(moving, acceleration * dt**2, 0.0)
    total = q[:, 0, 0] + measurement
    gain, seen, place = q[:, :, 0] / total[:, None], f[:, 0, :], np.stack([x, y], 1)
    outer = lambda u, v: u[:, :, None] * v[:, None, :]
    return Elements(f - outer(gain, seen), outer(gain, place), q - outer(gain, q[:, 0, :]), outer(seen, place) / total[:, None, None], outer(seen, seen) / total[:, None, None])


def _inverse(m: np.ndarray) -> np.ndarray:
    det = m[:, 0, 0] * m[:, 1, 1] - m[:, 0, 1] * m[:, 1, 0]
    out = np.empty_like(m)
    out[:, 0, 0], out[:, 1, 1], out[:, 0, 1], out[:, 1, 0] = m[:, 1, 1], m[:, 0, 0], -m[:, 0, 1], -m[:, 1, 0]
    return out / det[:, None, None]


def after(first: Elements, second: Elements) -> Elements:
    """For each pair, the element of the first and then the second."""
    middle = _inverse(np.eye(2) + first.c @ second.j)
    turned = lambda m: np.swapaxes(m, 1, 2)
    on, back = second.a @ middle, turned(first.a) @ turned(middle)  # (1 + j c)^-1 is the transpose of (1 + c j)^-1
    return Elements(on @ first.a, on @ (first.b + first.c @ second.eta) + second.b, on @ first.c @ turned(second.a) + second.c, back @ (second.eta - second.j @ first.b) + first.eta, back @ second.j @ first.a + first.j)


def folded(elements: Elements) -> Elements:
    """One element of all, in their order; neighbours are put together pair by pair."""
    while len(elements) > 1:
        even = len(elements) // 2 * 2
        pairs = after(elements.take(slice(0, even, 2)), elements.take(slice(1, even, 2)))
        elements = pairs if even == len(elements) else joined([pairs, elements.take(slice(even, None))])
    return elements


def applied(element: Elements, mean: np.ndarray, covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The state that one element leads to."""
    found = after(fixed(mean, covariance), element)
    return found.b[0], found.c[0]
