"""Nearest candidates within a distance and a window of pt, by a tree of boxes, and how many there are, by a grid; numpy, in one task."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

TURN = 2 * math.pi
#: Boxes are widened by this share, so that rounding loses no candidate at their edges; the exact conditions follow.
SLACK = 1e-9
#: Points of a leaf; seeds searched at once; boxes held at once, unless a single seed needs more.
LEAF, SEEDS, BOXES = 8, 1024, 2_000_000
#: Seeds that share a window of the grid; pairs compared at once; cells along the distance's limit at most.
BAND, PAIRS, CELLS = 128, 1_000_000, 64
#: Boxes aren't cut along log pt below this share of the window's width: a seed's window holds several of them anyway.
THIN = 0.5


def distance_squared(direction, query, eta, partner_eta):
    """As kinematics.distance_squared, to the last digit."""
    turn = np.abs(direction - query)
    if (turn >= TURN).any():
        turn = np.fmod(turn, TURN)
    d, e = np.minimum(turn, TURN - turn), eta - partner_eta
    return d * d + e * e


class Tree:
    """Candidates in boxes of (direction, eta, pt), each cut into two of equal numbers."""

    def __init__(self, pt: np.ndarray, direction: np.ndarray, eta: np.ndarray, event: np.ndarray, rank: np.ndarray, max_distance: float | None, pt_tolerance: float | None):
        """event: numbers, -1 for none; rank: in the order of ids."""
        self.n = n = len(pt)
        self.pt, self.direction, self.eta, self.event, self.rank = pt, direction, eta, event, rank
        self.max_distance, self.pt_tolerance = max_distance, pt_tolerance
        self.depth = depth = max(0, math.ceil(math.log2(max(n, 1) / LEAF)))
        size = LEAF << depth
        x = np.mod(direction, TURN)
        window = 1.0 if pt_tolerance is None else max(2 * pt_tolerance, 1e-9)
        z = np.log(np.where(pt > 0, pt, 1e-300)) / window
        far = math.inf if max_distance is None or max_distance <= 0 else max_distance
        unit = 2 * far if far < math.pi else math.pi
        axes = np.stack([np.append(v, np.inf) for v in (x / unit, eta / unit, z)])
        at = np.minimum(np.arange(size), n)
        for level in range(depth):
            at = at.reshape(1 << level, -1)
            spread = np.empty((3, len(at)))
            for a in range(3):
                v = axes[a][at]
                spread[a] = np.where(at < n, v, -np.inf).max(axis=1) - v.min(axis=1)
            spread = np.nan_to_num(spread, nan=-1.0, posinf=0.0, neginf=-1.0)
            spread[2] = np.where(spread[2] > THIN, spread[2], -0.5) if pt_tolerance is not None else -0.5
            value = axes[spread.argmax(axis=0)[:, None], at]
            at = np.take_along_axis(at, np.argpartition(value, at.shape[1] // 2 - 1, axis=1), axis=1)
        self.leaves = at.reshape(1 << depth, LEAF)
        self.low, self.high = np.full((3, 2 << depth), np.inf), np.full((3, 2 << depth), -np.inf)
        self.count = np.zeros(2 << depth, dtype=np.int64)
        first = 1 << depth
        for a, v in enumerate((x, eta, pt)):
            self.low[a, first:] = np.append(v, np.inf)[self.leaves].min(axis=1)
            self.high[a, first:] = np.append(v, -np.inf)[self.leaves].max(axis=1)
        self.count[first:] = (self.leaves < n).sum(axis=1)
        for level in range(depth - 1, -1, -1):
            own, below = slice(1 << level, 2 << level), slice(2 << level, 4 << level)
            self.low[:, own] = self.low[:, below].reshape(3, -1, 2).min(axis=2)
            self.high[:, own] = self.high[:, below].reshape(3, -1, 2).max(axis=2)
            self.count[own] = self.count[below].reshape(-1, 2).sum(axis=1)

    def nearest(self, pt, query, partner_eta, event, rank, k):
        """(seed, candidate, d2) by positions, by (seed, d2, candidate's rank): the first k of each seed (an array).

        A candidate of the seed's event or of its rank is none.
        """
        out = []
        for i in range(0, len(pt), SEEDS):
            out += self._some(np.arange(i, min(i + SEEDS, len(pt))), pt, query, partner_eta, event, rank, k)
        if not out:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def _some(self, seeds, pt, query, partner_eta, event, rank, k):
        far = math.inf if self.max_distance is None else self.max_distance
        q, p, sp, ev, rk = np.mod(query[seeds], TURN), partner_eta[seeds], pt[seeds], event[seeds], rank[seeds]
        # As many of any candidates as leave k when those of the seed's own event are gone.
        own = np.bincount(self.event[self.event >= 0], minlength=max(int(event.max(initial=-1)), int(self.event.max(initial=-1))) + 1) if not hasattr(self, "_own") else self._own
        self._own = own
        need = k[seeds] + 1 + np.where((ev >= 0) & (ev < len(own)), own[np.clip(ev, 0, len(own) - 1)] if len(own) else 0, 0)
        reach = np.full(len(seeds), far * (1 + SLACK) + SLACK)
        slack = SLACK * np.abs(sp)
        room = (0 if self.pt_tolerance is None else self.pt_tolerance) * sp
        s, box = np.arange(len(seeds)), np.ones(len(seeds), dtype=np.int64)
        for level in range(self.depth + 1):
            lx, ly, lz = self.low[0][box], self.low[1][box], self.low[2][box]
            wide, hy, hz = self.high[0][box] - lx, self.high[1][box], self.high[2][box]
            past = np.mod(q[s] - np.where(self.count[box] > 0, lx, 0.0), TURN)
            dx = np.where(past <= wide, 0.0, np.minimum(past - wide, TURN - past))
            dy = np.maximum(np.maximum(ly - p[s], p[s] - hy), 0.0)
            keep = self.count[box] > 0
            if self.pt_tolerance is not None:
                keep &= (hz >= (sp - room - slack)[s]) & (lz <= (sp + room + slack)[s])
            near = np.sqrt(dx * dx + dy * dy)
            # A box within the window that holds enough bounds how far the seed has to look.
            full = keep & (self.count[box] >= need[s])
            if self.pt_tolerance is not None:
                full &= (lz >= (sp - room + slack)[s]) & (hz <= (sp + room - slack)[s])
            if full.any():
                f = np.flatnonzero(full)
                a, b = np.minimum(past[f], TURN - past[f]), np.abs(past[f] - wide[f])
                mx = np.where(np.mod(past[f] + math.pi, TURN) <= wide[f], math.pi, np.maximum(a, np.minimum(b, TURN - b)))
                my = np.maximum(p[s[f]] - ly[f], hy[f] - p[s[f]])
                np.minimum.at(reach, s[f], np.sqrt(mx * mx + my * my) * (1 + SLACK) + SLACK)
            keep &= near <= reach[s]
            s, box = s[keep], box[keep]
            if len(s) > BOXES and len(seeds) > 1:
                half = len(seeds) // 2
                return self._some(seeds[:half], pt, query, partner_eta, event, rank, k) + self._some(seeds[half:], pt, query, partner_eta, event, rank, k)
            if level < self.depth:
                s, box = np.repeat(s, 2), np.repeat(2 * box, 2)
                box[1::2] += 1
        s, c = np.repeat(s, LEAF), self.leaves[box - (1 << self.depth)].ravel()
        there = c < self.n
        s, c = s[there], c[there]
        if self.pt_tolerance is not None:
            there = np.abs(self.pt[c] - sp[s]) <= self.pt_tolerance * sp[s]
            s, c = s[there], c[there]
        d2 = distance_squared(self.direction[c], query[seeds][s], self.eta[c], p[s])
        good = (rk[s] != self.rank[c]) & ((ev[s] < 0) | (ev[s] != self.event[c])) & ~(np.sqrt(d2) > reach[s])
        if self.max_distance is not None:
            good &= np.sqrt(d2) <= self.max_distance
        s, c, d2 = s[good], c[good], d2[good]
        order = np.lexsort((self.rank[c], d2, s))
        s, c, d2 = s[order], c[order], d2[order]
        first = np.arange(len(s)) - np.searchsorted(s, s) < k[seeds][s]
        return [(seeds[s[first]], c[first], d2[first])]


def within_first(k: int, pt, direction, eta, event, rank) -> np.ndarray:
    """Positions without those candidates of equal coordinates of which no seed takes any among its k, as enough of lower ids and other events precede them."""
    rows = pd.DataFrame({"pt": pt + 0.0, "direction": direction + 0.0, "eta": eta + 0.0, "event": event, "rank": rank})
    at = ["pt", "direction", "eta"]
    copies = rows.duplicated(at, keep=False).to_numpy()
    if not copies.any():
        return np.arange(len(rows))
    some = rows[copies].sort_values("rank")
    spot = some.groupby(at, sort=False).ngroup()
    own = some.assign(spot=spot, own=np.where(some["event"] >= 0, 1, 0)).groupby(["spot", "event"], sort=False)["own"].transform("sum").groupby(spot).transform("max")
    keep = ~copies
    keep[some.index[(some.groupby(spot).cumcount() < k + 1 + own).to_numpy()]] = True
    return np.flatnonzero(keep)


def nearest(seeds: dict, lib: dict, max_distance: float | None, pt_tolerance: float | None):
    """(seed, candidate, d2) by positions, as Tree.nearest. seeds: pt, query, partner_eta, event, rank, k; lib: pt, direction, eta, event, rank."""
    out, below = [], 0
    k, coordinates = seeds["k"], ("pt", "direction", "eta", "event", "rank")
    while below < k.max(initial=0):  # seeds that ask for many don't bring others all copies
        top = max(4 * below, 1) if (k > max(4 * below, 1)).any() else int(k.max())
        some = np.flatnonzero((k > below) & (k <= top))
        if len(some):
            kept = within_first(top, *(lib[c] for c in coordinates))
            tree = Tree(*(lib[c][kept] for c in coordinates), max_distance, pt_tolerance)
            s, c, d2 = tree.nearest(*(seeds[x][some] for x in ("pt", "query", "partner_eta", "event", "rank", "k")))
            out.append((some[s], kept[c], d2))
        below = top
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def windows(pt: np.ndarray, seeds: np.ndarray, tolerance: float | None):
    """[low, high) of each seed: the positions in pt, which is sorted, of what lies within its window, by the exact condition."""
    if tolerance is None:
        return np.zeros(len(seeds), dtype=np.int64), np.full(len(seeds), len(pt))
    room = tolerance * seeds

    def first(holds):
        low, high = np.zeros(len(seeds), dtype=np.int64), np.full(len(seeds), len(pt))
        while (going := low < high).any():
            middle = (low + high) // 2
            true = holds(pt[np.minimum(middle, len(pt) - 1)])
            low, high = np.where(going & ~true, middle + 1, low), np.where(going & true, middle, high)
        return low

    low = first(lambda x: (x >= seeds) | (seeds - x <= room))
    return low, np.where(room >= 0, first(lambda x: (x > seeds) & (x - seeds > room)), low)


def _runs(first, length):
    """(run, position) of all positions of the runs, in parts of about PAIRS."""
    done, ends = 0, np.cumsum(length)
    while done < len(length):
        upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS, side="right")))
        n = length[done:upto]
        run = np.repeat(np.arange(done, upto), n)
        yield run, np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n) + first[run]
        done = upto


class Grid:
    """Candidates of equal coordinates as one spot each, in cells of (direction, eta).

    Seeds come by their pt, BAND at a time. What is in the windows of all of a band is counted by
    whole cells, as far as these are within the distance; cells at the limit, and what is in the
    windows of some of the band only, are compared one by one.
    """

    def __init__(self, seeds: dict, lib: dict, max_distance: float | None, pt_tolerance: float | None):
        self.max_distance = max_distance
        self.query, self.partner_eta = seeds["query"], seeds["partner_eta"]
        order = np.lexsort((lib["eta"], lib["direction"], lib["pt"]))
        pt, direction, eta = (lib[c][order] + 0.0 for c in ("pt", "direction", "eta"))
        new = np.append(True, (pt[1:] != pt[:-1]) | (direction[1:] != direction[:-1]) | (eta[1:] != eta[:-1]))
        self.spot = np.empty(len(order), dtype=np.int64)
        self.spot[order] = np.cumsum(new) - 1
        self.pt, self.direction, self.eta, self.weight = pt[new], direction[new], eta[new], np.bincount(self.spot)
        self.low, self.high = windows(self.pt, seeds["pt"], pt_tolerance)
        self.count, self.farthest = np.zeros(len(self.query), dtype=np.int64), np.full(len(self.query), -1.0)
        self._drop_own(seeds, lib)
        self._cells()

    def _drop_own(self, seeds, lib):
        """Takes candidates of a seed's event or rank off its count; spots that hold no others are marked, as none of them is the farthest."""
        keys = [np.zeros(0, dtype=np.int64)]
        for name in ("event", "rank"):
            order = np.argsort(lib[name], kind="stable")
            first, last = (np.searchsorted(lib[name][order], seeds[name], side=side) for side in ("left", "right"))
            for s, at in _runs(first, np.where(seeds[name] >= 0, last - first, 0)):
                c = order[at]
                if name == "rank":
                    other = (seeds["event"][s] < 0) | (seeds["event"][s] != lib["event"][c])
                    s, c = s[other], c[other]
                keys.append(s * len(self.pt) + self.spot[c])
        keys, own = np.unique(np.concatenate(keys), return_counts=True)
        s, spot = keys // len(self.pt), keys % len(self.pt)
        d2, inside = self._near(s, spot)
        inside &= (spot >= self.low[s]) & (spot < self.high[s])
        np.subtract.at(self.count, s[inside], own[inside])
        gone = inside & (own == self.weight[spot])
        self.gone, self.gone_below = keys[gone], np.full(len(self.query), -1.0)
        np.maximum.at(self.gone_below, s[gone], d2[gone])

    def _cells(self):
        n, spread = len(self.pt), float(np.ptp(self.eta))
        x = np.mod(self.direction, TURN)
        high = max(self.eta.max(), self.partner_eta.max()) - min(self.eta.min(), self.partner_eta.min())
        far = math.hypot(math.pi, high) if self.max_distance is None else min(self.max_distance, math.hypot(math.pi, high))
        self.eps = SLACK * max(1.0, far, np.abs(self.eta).max(), np.abs(self.partner_eta).max())
        self.reach, unit = far + 2 * self.eps, max(far, 1e-6)
        # Of cells in all, half as many as spots in a window.
        area = len(np.unique((x * (CELLS / TURN)).astype(np.int64))) * (TURN / CELLS) * spread / unit**2
        k = min(max(math.sqrt(float((self.high - self.low).mean()) / (2 * max(area, 1e-9))), 0.25), CELLS)
        self.nx = int(min(max(TURN * k / unit, 1), 1 << 16))
        self.wx = TURN / self.nx
        used, column = np.unique(np.minimum((x / self.wx).astype(np.int64), self.nx - 1), return_inverse=True)
        self.column = np.full(self.nx, -1)
        self.column[used] = np.arange(len(used))
        self.ny = max(1, int(min(spread * k / unit, max(1 << 16, 4 * n) / len(used))))
        self.wy, self.bottom = spread / self.ny or 1.0, self.eta.min()
        self.cell = column * self.ny + np.minimum(((self.eta - self.bottom) / self.wy).astype(np.int64), self.ny - 1)
        self.size = len(used) * self.ny
        self.order = np.argsort(self.cell, kind="stable")
        self.upto = np.append(0, np.cumsum(self.weight[self.order]))
        base = np.cumsum(np.bincount(self.cell, minlength=self.size)) - np.bincount(self.cell, minlength=self.size)
        # The spots of a cell from first to last are those in the windows of all of the band.
        self.first, self.last, self.at_first, self.at_last = base, base.copy(), 0, 0

    def _near(self, s, spot):
        d2 = distance_squared(self.direction[spot], self.query[s], self.eta[spot], self.partner_eta[s])
        return d2, np.ones(len(s), dtype=bool) if self.max_distance is None else np.sqrt(d2) <= self.max_distance

    def _compare(self, s, spot, counted: bool = True):
        d2, inside = self._near(s, spot)
        s, spot, d2 = s[inside], spot[inside], d2[inside]
        if counted:
            np.add.at(self.count, s, self.weight[spot])
        new = d2 > self.farthest[s]
        asked = np.flatnonzero(new & (d2 <= self.gone_below[s]))
        if len(asked):
            key = s[asked] * len(self.pt) + spot[asked]
            new[asked] = self.gone[np.minimum(np.searchsorted(self.gone, key), len(self.gone) - 1)] != key
        np.maximum.at(self.farthest, s[new], d2[new])

    def _move(self, low, high):
        for name, at, to in (("first", self.at_first, low), ("last", self.at_last, high)):
            moved = np.bincount(self.cell[min(at, to) : max(at, to)], minlength=self.size)
            setattr(self, name, getattr(self, name) + (moved if to > at else -moved))
        self.at_first, self.at_last = low, high

    def _some(self, seeds):
        """What is in the windows of some of the seeds, then what is in those of all."""
        low, high = self.low[seeds], self.high[seeds]
        a, b = int(low.max()), int(high.min())
        parts = [(int(low.min()), a), (b, int(high.max()))] if a < b else [(int(low.min()), int(high.max()))]
        step = PAIRS // BAND
        for i, j in ((i, min(i + step, end)) for start, end in parts for i in range(start, end, step)):
            spot = np.arange(i, j)
            there = (spot >= low[:, None]) & (spot < high[:, None]) & (np.abs(self.eta[i:j] - self.partner_eta[seeds][:, None]) <= self.reach)
            s, c = np.nonzero(there)
            self._compare(seeds[s], spot[c])
        if a < b:
            self._move(a, b)
            self._whole(seeds)

    def _rows(self, p, width, outwards: bool):
        """Rows from p - width to p + width: all that are touched, or those that are wholly between; none for a width below 0."""
        down, up = (p - width - self.bottom) / self.wy, (p + width - self.bottom) / self.wy
        low, high = (np.floor(down), np.floor(up) + 1) if outwards else (np.ceil(down), np.floor(up))
        if outwards:  # the last row ends with its highest spot
            low = np.minimum(low, self.ny - 1)
        low, high = (np.clip(x, 0, self.ny).astype(np.int64) for x in (low, high))
        return low, np.where(width >= 0, np.maximum(high, low), low)

    def _whole(self, seeds):
        held = self.upto[self.last] - self.upto[self.first]
        below = np.zeros((self.size // self.ny, self.ny + 1), dtype=np.int64)
        np.cumsum(held.reshape(-1, self.ny), axis=1, out=below[:, 1:])
        q = np.mod(self.query[seeds], TURN)
        start = np.floor((q - min(self.reach, math.pi)) / self.wx)
        t = start[:, None] + np.arange(min(self.nx, int(2 * self.reach / self.wx) + 2))
        left = t * self.wx - q[:, None]
        far = np.maximum(np.abs(left), np.abs(left + self.wx))
        near = np.maximum(np.minimum(np.maximum(np.maximum(left, -left - self.wx), 0), TURN - far), 0) - self.eps
        far, near = np.minimum(far, math.pi) + self.eps, np.maximum(near, 0)
        column = self.column[np.mod(t, self.nx).astype(np.int64)]
        s, at = np.nonzero((column >= 0) & (near <= self.reach))
        near, far, column, s = near[s, at], far[s, at], column[s, at], seeds[s]
        p = self.partner_eta[s]
        limit = self.reach - 4 * self.eps
        o1, o2 = self._rows(p, np.sqrt(np.maximum(self.reach**2 - near * near, 0)) + self.eps, True)
        if self.max_distance is None:
            i1, i2 = o1, o2
        else:
            i1, i2 = self._rows(p, np.where(far <= limit, np.sqrt(np.maximum(limit**2 - far * far, 0)) - self.eps, -1.0), False)
            i1, i2 = np.clip(i1, o1, o2), np.clip(i2, o1, o2)
        i2 = np.maximum(i1, i2)
        np.add.at(self.count, s, below[column, i2] - below[column, i1])
        self._open(np.concatenate([s, s]), np.concatenate([column * self.ny + o1, column * self.ny + i2]), np.concatenate([i1 - o1, o2 - i2]))
        # Of whole cells, those with a corner beyond the farthest so far.
        best = self.farthest[s]
        j1, j2 = self._rows(p, np.where(best >= far * far, np.sqrt(np.maximum(best - far * far, 0)) - self.eps, -1.0), False)
        j1, j2 = np.clip(j1, i1, i2), np.clip(j2, i1, i2)
        j1, j2 = np.where(j1 < j2, j1, i2), np.where(j1 < j2, j2, i2)
        self._beyond(np.concatenate([s, s]), np.concatenate([far, far]), np.concatenate([column, column]), np.concatenate([i1, j2]), np.concatenate([j1 - i1, i2 - j2]))

    def _open(self, s, cells, length, counted: bool = True):
        """Compares what is in runs of cells."""
        for run, cell in _runs(cells, length):
            n = self.last[cell] - self.first[cell]
            run, cell, n = run[n > 0], cell[n > 0], n[n > 0]
            for one, at in _runs(self.first[cell], n):
                self._compare(s[run[one]], self.order[at], counted)

    def _beyond(self, s, far, column, row, length):
        left = []
        for run, r in _runs(row, length):
            cell = column[run] * self.ny + r
            edge = self.bottom + r * self.wy - self.partner_eta[s[run]]
            y = np.maximum(np.abs(edge), np.abs(edge + self.wy)) + self.eps
            corner = far[run] ** 2 + y * y
            keep = (self.last[cell] > self.first[cell]) & (corner > self.farthest[s[run]])
            left.append((s[run[keep]], cell[keep], corner[keep]))
        if not left:
            return
        s, cell, corner = (np.concatenate(x) for x in zip(*left, strict=True))
        order = np.lexsort((-corner, s))
        s, cell, corner, n = s[order], cell[order], corner[order], 1
        while len(s):  # the farthest corners first
            now = np.arange(len(s)) - np.searchsorted(s, s) < n
            self._open(s[now], cell[now], np.ones(int(now.sum()), dtype=np.int64), False)
            later = ~now & (corner > self.farthest[s])
            s, cell, corner, n = s[later], cell[later], corner[later], 2 * n

    def totals(self):
        order = np.lexsort((self.high, self.low))
        for i in range(0, len(order), BAND):
            self._some(np.sort(order[i : i + BAND]))
        return self.count, self.farthest


def totals(seeds: dict, lib: dict, max_distance: float | None, pt_tolerance: float | None):
    """(number of candidates, largest d2 among them) of each seed; a seed without any has (0, -1). seeds, lib: as for nearest, without k."""
    if not len(seeds["pt"]) or not len(lib["pt"]):
        return np.zeros(len(seeds["pt"]), dtype=np.int64), np.full(len(seeds["pt"]), -1.0)
    return Grid(seeds, lib, max_distance, pt_tolerance).totals()
