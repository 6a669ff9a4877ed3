"""Numpy slab sweep over polygon edges: the helper inside the overlay's grouped maps.

Polygons are even-odd edge sets. Horizontal lines through every vertex and
every edge crossing cut the plane into slabs; inside a slab edges do not cross,
so sorting them by x yields elementary trapezoids and, per trapezoid, the
polygons that cover it. Many independent groups are swept in one vectorized
pass; no ring is ever walked in Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PAIR_CHUNK = 4_000_000


@dataclass
class Sweep:
    """Elementary trapezoids and the (trapezoid, polygon) cover list."""

    group: np.ndarray
    slab: np.ndarray
    y_lo: np.ndarray
    y_hi: np.ndarray
    left: np.ndarray
    right: np.ndarray
    xl_lo: np.ndarray
    xl_hi: np.ndarray
    xr_lo: np.ndarray
    xr_hi: np.ndarray
    cover_trap: np.ndarray
    cover_poly: np.ndarray

    @property
    def area(self) -> np.ndarray:
        return ((self.xr_lo - self.xl_lo) + (self.xr_hi - self.xl_hi)) * 0.5 * (self.y_hi - self.y_lo)


def _dense(group: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, y) in order, and the position of every input among them."""
    order = np.lexsort((y, group))
    g, v = group[order], y[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
    inverse = np.empty(len(g), np.int64)
    inverse[order] = np.cumsum(first) - 1
    return g[first], v[first], inverse


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner index and running offset for ``counts[i]`` repetitions of each ``i``."""
    owner = np.repeat(np.arange(len(counts)), counts)
    start = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - start[owner]


def _crossings(group, x0, y0, x1, y1) -> tuple[np.ndarray, np.ndarray]:
    """(group, y) of proper crossings between edges of one group (edges point upwards)."""
    n = len(group)
    _, _, rank = _dense(np.concatenate([group, group]), np.concatenate([y0, y1]))
    order = np.argsort(rank[:n], kind="stable")
    low, high = rank[:n][order], rank[n:][order]
    counts = np.maximum(np.searchsorted(low, high, "left") - np.arange(n) - 1, 0)
    out_g, out_y = [], []
    bounds = np.concatenate([[0], np.cumsum(counts)])
    start = 0
    while start < n:
        stop = int(np.searchsorted(bounds, bounds[start] + PAIR_CHUNK, "right")) - 1
        stop = min(max(stop, start + 1), n)
        owner, offset = _spread(counts[start:stop])
        i = order[owner + start]
        j = order[owner + start + 1 + offset]
        near = (np.minimum(x0[i], x1[i]) <= np.maximum(x0[j], x1[j])) & (
            np.minimum(x0[j], x1[j]) <= np.maximum(x0[i], x1[i])
        )
        i, j = i[near], j[near]
        ax, ay = x1[i] - x0[i], y1[i] - y0[i]
        bx, by = x1[j] - x0[j], y1[j] - y0[j]
        det = ax * by - ay * bx
        ok = det != 0.0
        i, j, ax, ay, bx, by, det = i[ok], j[ok], ax[ok], ay[ok], bx[ok], by[ok], det[ok]
        qx, qy = x0[j] - x0[i], y0[j] - y0[i]
        s, t = (qx * by - qy * bx) / det, (qx * ay - qy * ax) / det
        y = y0[i] + s * ay
        hit = (s >= 0) & (s <= 1) & (t >= 0) & (t <= 1) & (y > np.maximum(y0[i], y0[j])) & (y < np.minimum(y1[i], y1[j]))
        out_g.append(group[i][hit])
        out_y.append(y[hit])
        start = stop
    return np.concatenate(out_g), np.concatenate(out_y)


def sweep(group, poly, x0, y0, x1, y1) -> Sweep:
    """Sweep edges ``(x0,y0)-(x1,y1)`` of even-odd polygons ``poly``, independently per ``group``."""
    keep = y0 != y1
    group, poly, x0, y0, x1, y1 = (a[keep] for a in (group, poly, x0, y0, x1, y1))
    if len(group) == 0:
        none_i, none_f = np.empty(0, np.int64), np.empty(0)
        return Sweep(none_i, none_i, none_f, none_f, none_i, none_i, none_f, none_f, none_f, none_f, none_i, none_i)
    flip = y0 > y1
    x0, x1 = np.where(flip, x1, x0), np.where(flip, x0, x1)
    y0, y1 = np.where(flip, y1, y0), np.where(flip, y0, y1)
    cg, cy = _crossings(group, x0, y0, x1, y1)
    n = len(group)
    bg, by, inverse = _dense(np.concatenate([group, group, cg]), np.concatenate([y0, y1, cy]))
    first, last = inverse[:n], inverse[n : 2 * n]

    edge, offset = _spread(last - first)
    slab = first[edge] + offset
    mid = (by[slab] + by[slab + 1]) * 0.5
    x_mid = x0[edge] + (mid - y0[edge]) / (y1[edge] - y0[edge]) * (x1[edge] - x0[edge])
    order = np.lexsort((poly[edge], x_mid, slab))
    edge, slab, x_mid = edge[order], slab[order], x_mid[order]
    pos = np.arange(len(edge))

    by_poly = np.lexsort((pos, poly[edge], slab))
    s, p = slab[by_poly], poly[edge][by_poly]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | (p[1:] != p[:-1])
    begin = np.flatnonzero(fresh)
    nth = np.arange(len(s)) - begin[np.cumsum(fresh) - 1]
    entering = np.flatnonzero(nth % 2 == 0)
    entering = entering[entering + 1 < len(s)]
    same = (s[entering + 1] == s[entering]) & (p[entering + 1] == p[entering])
    entering = entering[same]
    enter_pos, exit_pos = by_poly[entering], by_poly[entering + 1]

    wide = np.zeros(len(edge), bool)
    wide[:-1] = (slab[1:] == slab[:-1]) & (x_mid[1:] > x_mid[:-1])
    trap_of = np.cumsum(wide) - 1
    at = np.flatnonzero(wide)
    left, right = edge[at], edge[at + 1]
    k = slab[at]
    lo, hi = by[k], by[k + 1]

    def x_at(e, y):
        return x0[e] + (y - y0[e]) / (y1[e] - y0[e]) * (x1[e] - x0[e])

    xl_lo, xl_hi = x_at(left, lo), x_at(left, hi)
    xr_lo, xr_hi = np.maximum(x_at(right, lo), xl_lo), np.maximum(x_at(right, hi), xl_hi)

    owner, step = _spread(exit_pos - enter_pos)
    where = enter_pos[owner] + step
    live = wide[where]
    return Sweep(
        bg[k], k, lo, hi, left, right, xl_lo, xl_hi, xr_lo, xr_hi,
        trap_of[where[live]], p[entering][owner[live]],
    )


def merge_runs(s: Sweep, rows: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, ...]:
    """Join neighbouring trapezoids of a label: side by side in a slab, then above each other between the same edges.

    ``rows`` are in ascending order. Returns ``label, y_lo, y_hi, xl_lo, xl_hi,
    xr_lo, xr_hi`` arrays; joined pieces meet only along horizontal lines and
    tile sides.
    """
    apart = np.ones(len(rows), bool)
    apart[1:] = (np.diff(rows) != 1) | (s.slab[rows][1:] != s.slab[rows][:-1]) | (label[1:] != label[:-1])
    first = np.flatnonzero(apart)
    ends = rows[np.append(first[1:], len(rows)) - 1] if len(rows) else rows
    rows, label = rows[first], label[first]
    right, xr_lo, xr_hi = s.right.copy(), s.xr_lo.copy(), s.xr_hi.copy()
    right[rows], xr_lo[rows], xr_hi[rows] = s.right[ends], s.xr_lo[ends], s.xr_hi[ends]
    order = np.lexsort((s.slab[rows], right[rows], s.left[rows], label))
    r, lab = rows[order], label[order]
    cut = np.ones(len(r), bool)
    if len(r) > 1:
        cut[1:] = (
            (lab[1:] != lab[:-1])
            | (s.left[r][1:] != s.left[r][:-1])
            | (right[r][1:] != right[r][:-1])
            | (s.slab[r][1:] != s.slab[r][:-1] + 1)
        )
    head = np.flatnonzero(cut)
    tail = np.append(head[1:], len(r)) - 1 if len(r) else head
    a, b = r[head], r[tail]
    return lab[head], s.y_lo[a], s.y_hi[b], s.xl_lo[a], s.xl_hi[b], xr_lo[a], xr_hi[b]


def circle_edges(radius: float, segments: int, cx: float = 0.0, cy: float = 0.0) -> np.ndarray:
    """Edges of the regular polygon that stands for a circle, as an (n, 4) array."""
    angle = 2.0 * np.pi * np.arange(segments) / segments
    x, y = cx + np.cos(angle) * radius, cy + np.sin(angle) * radius
    return np.column_stack([x, y, np.roll(x, -1), np.roll(y, -1)])


def clamp_to_tile(e: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """Restrict edges to a tile: cut to its rows, push edges beside it onto its left or right side."""
    ax, ay, bx, by = e.T
    keep = (ay != by) & (np.maximum(ay, by) > y0) & (np.minimum(ay, by) < y1)
    ax, ay, bx, by = ax[keep], ay[keep], bx[keep], by[keep]
    na, nb = np.clip(ay, y0, y1), np.clip(by, y0, y1)
    slope = (bx - ax) / (by - ay)
    cxa, cxb = np.where(na == ay, ax, ax + (na - ay) * slope), np.where(nb == by, bx, ax + (nb - ay) * slope)
    out_l, out_r = np.maximum(cxa, cxb) <= x0, np.minimum(cxa, cxb) >= x1
    cxa = np.where(out_l, x0, np.where(out_r, x1, cxa))
    cxb = np.where(out_l, x0, np.where(out_r, x1, cxb))
    return np.column_stack([cxa, na, cxb, nb])


def tile_edges(x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    return np.array([[x0, y0, x0, y1], [x1, y1, x1, y0]])


def label_components(s: Sweep, selected: np.ndarray, zone: np.ndarray) -> np.ndarray:
    """Connected pieces of the selected trapezoids (same group and zone, touching along a segment), named by their first one."""
    n = len(s.slab)
    beside = np.flatnonzero(selected[1:] & selected[:-1] & (s.slab[1:] == s.slab[:-1]) & (zone[1:] == zone[:-1]))
    # Above each other: the upper side of one meets the lower sides of a run of trapezoids in the next slab.
    below, above = np.flatnonzero(selected), np.arange(n)
    line = np.concatenate([s.slab[below] + 1, s.slab[below] + 1, s.slab, s.slab])
    _, _, rank = _dense(line, np.concatenate([s.xl_hi[below], s.xr_hi[below], s.xl_lo, s.xr_lo]))
    a, b, left, right = np.split(rank, np.cumsum([len(below), len(below), n]))
    first, stop = np.searchsorted(np.maximum.accumulate(right), a, "right"), np.searchsorted(np.maximum.accumulate(left), b, "left")
    at, step = _spread(np.maximum(stop - first, 0))
    i, j = below[at], above[first[at] + step]
    near = selected[j] & (s.slab[j] == s.slab[i] + 1) & (zone[i] == zone[j])
    near &= np.minimum(s.xr_hi[i], s.xr_lo[j]) - np.maximum(s.xl_hi[i], s.xl_lo[j]) > 1e-9
    u, v = np.concatenate([beside, i[near]]), np.concatenate([beside + 1, j[near]])
    label = np.arange(n)
    while True:
        p, q = label[u], label[v]
        low = np.minimum(p, q)
        if np.array_equal(p, q):
            return label
        np.minimum.at(label, p, low)
        np.minimum.at(label, q, low)
        while not np.array_equal(label, up := label[label]):
            label = up
