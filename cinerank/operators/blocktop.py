"""The best products of two blocks of vectors without keeping their score matrix.

Single-precision products of a few rows with a few columns at a time only decide which pairs
can still be among a row's best; the scores of those are worked out in double precision.  A
row's bound rises with the columns it has met, so that soon almost no pair passes it.

Columns are met from the longest on, and a row leaves when its length times theirs does not
reach its bound (:func:`best_products`).  Where all lengths are alike columns lie in small cells of
like directions instead, and a row meets only cells whose angles reach its bound
(:func:`best_near`).  Both are exact: what is left out cannot be among a row's best."""

from __future__ import annotations

import numpy as np

from cinerank.config import FIXED_DIGITS

ROW_CHUNK = 512       # rows multiplied at a time
COLUMN_CHUNK = 2048   # columns multiplied at a time: the product stays in a core's cache
DENSE_SHARE = 0.05    # from this share of passing pairs on, the whole product is scored at once
PAIR_SLICE = 1 << 18  # passing pairs scored at a time
SINGLE = 2.0 ** -22   # noise of a single-precision product, for each component and unit of both lengths
CELL = 96             # columns of a cell, about; none has more than twice as many
FIRST_CELLS = 8       # cells a row's first bound is taken from
CONE_CELLS = 1 << 24  # rows x cells looked at at a time
LEAST_ALIKE = 4096    # fewer columns than this are multiplied without cells
ANGLE_SLACK = 1e-3    # radians: noise of single-precision angles
ALWAYS = 1e6          # more than any product of unit vectors


def round_half_away(x: np.ndarray, digits: int) -> np.ndarray:
    """NumPy twin of :func:`cinerank.functions.columns.round_score`."""
    fixed = np.abs(np.round(x, FIXED_DIGITS))
    scale = 10.0 ** digits
    # the product is rounded again: an exact half may land just below .5
    return np.sign(x) * np.floor(np.round(fixed * scale, FIXED_DIGITS - digits) + 0.5) / scale


def pair_products(one: np.ndarray, two: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Products of the rows ``r`` of ``one`` with the rows ``c`` of ``two``, pair by pair."""
    parts = [np.einsum("ij,ij->i", one[r[at:at + PAIR_SLICE]], two[c[at:at + PAIR_SLICE]]) for at in range(0, len(r), PAIR_SLICE)]
    return np.concatenate(parts) if parts else np.empty(0)


def _passing(mask: np.ndarray) -> np.ndarray:
    """Flat positions of the few true entries of ``mask``, found eight entries at a time."""
    flat = mask.reshape(-1)
    if flat.size % 8:
        return np.flatnonzero(flat)
    some = np.flatnonzero(flat.view("uint64") != 0)
    word, bit = np.nonzero(flat.reshape(-1, 8)[some])
    return some[word] * 8 + bit


def _cut(r, c, score, k: int, n_rows: int):
    """The first ``k`` of each row by (score desc, column asc), and each row's kth score (-inf if fewer)."""
    order = np.lexsort((c, -score, r))
    r, c, score = r[order], c[order], score[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    keep = rank < k
    kth = np.full(n_rows, -np.inf)
    last = rank == k - 1
    kth[r[last]] = score[last]
    return r[keep], c[keep], score[keep], kth


def best_products(one: np.ndarray, two: np.ndarray, k: int, digits: int, min_score: float | None = None,
                  floors: np.ndarray | None = None, own: np.ndarray | None = None, products=pair_products,
                  rounded=round_half_away):
    """Each row of ``one``'s ``k`` best rows of ``two`` by (rounded product desc, position in ``two`` asc):
    ``(row, position, rounded score)`` arrays.

    * ``min_score``: only products above it (strict, at FIXED_DIGITS decimals) count.
    * ``floors``: a row's products that are more than two units of the last digit below its
      entry may be left out.
    * ``own``: a row's position in ``two`` that does not count (-1: none).
    * NaN products do not count."""
    reach = np.sqrt((two * two).sum(1))
    if products is pair_products and len(two) >= LEAST_ALIKE and 0 < reach.max() <= (1 + 1e-6) * reach.min() and np.isfinite(one).all():
        return best_near(one, two, k, digits, min_score, floors, own)
    # the longest first, those of unknown length before
    reach = np.where(np.isnan(reach), np.inf, reach)
    place = np.argsort(-reach, kind="stable")
    two, reach = two[place], reach[place]
    small, other = one.astype("float32"), two.astype("float32")
    lengths, longest = np.sqrt((one * one).sum(1)), reach[np.isfinite(reach)].max(initial=0.0)
    noise = SINGLE * max(1, one.shape[1]) * lengths * longest + 2.2 * 10.0 ** -digits
    out, product = [[], [], []], np.empty(ROW_CHUNK * COLUMN_CHUNK, "float32")
    mask = np.empty(ROW_CHUNK * COLUMN_CHUNK, bool)
    for s0 in range(0, len(one), ROW_CHUNK):
        rows = slice(s0, s0 + ROW_CHUNK)
        n = len(one[rows])
        low = np.full(n, -np.inf) if min_score is None else np.full(n, min_score)
        if floors is not None:
            low = np.maximum(low, floors[rows])
        kept, new, met, due = (np.empty(0, int), np.empty(0, int), np.empty(0)), [], 0, 1
        bound = (low - noise[rows]).astype("float32")
        for c0 in range(0, len(two), COLUMN_CHUNK):
            width = min(COLUMN_CHUNK, len(two) - c0)
            with np.errstate(invalid="ignore"):
                at = s0 + np.flatnonzero(lengths[rows] * reach[c0] * (1 + 1e-6) >= bound)
            if not len(at):                   # later columns reach no further
                break
            near = small[at] if len(at) < n else small[rows]
            raw = np.matmul(near, other[c0:c0 + COLUMN_CHUNK].T, out=product[:len(at) * width].reshape(len(at), width))
            if c0 == 0 and width > k + 1:
                # a first bound: the kth best of these columns (the own position is one more)
                kth = np.partition(np.where(np.isnan(raw), -np.inf, raw), -k - 1, axis=1)[:, -k - 1]
                bound[at - s0] = np.maximum(bound[at - s0], kth - 2 * noise[at].astype("float32"))
            passing = _passing(np.greater_equal(raw, bound[at - s0, None], out=mask[:len(at) * width].reshape(len(at), width)))
            r, c = np.divmod(passing, width)
            if len(r) > DENSE_SHARE * raw.size and products is pair_products:
                score = (one[at] @ two[c0:c0 + COLUMN_CHUNK].T)[r, c]
            else:
                score = products(one[at], two[c0:c0 + COLUMN_CHUNK], r, c)
            r, c = at[r] - s0, place[c + c0]
            count = ~np.isnan(score)
            if min_score is not None:
                count &= np.round(score, FIXED_DIGITS) > min_score
            if own is not None:
                count &= c != own[rows][r]
            new.append((r[count], c[count], rounded(score[count], digits)))
            met += len(new[-1][0])
            # at doubling distances, and whenever much has passed, the bound rises
            if c0 // COLUMN_CHUNK + 1 >= due or met > 4 * k * n:
                *kept, kth = _cut(*(np.concatenate(x) for x in zip(kept, *new)), k, n)
                new, met, due = [], 0, 2 * (c0 // COLUMN_CHUNK + 1)
                bound = np.maximum(bound, (np.maximum(low, kth) - noise[rows]).astype("float32"))
        if new:
            *kept, _ = _cut(*(np.concatenate(x) for x in zip(kept, *new)), k, n)
        for part, x in zip(out, (kept[0] + s0, kept[1], kept[2])):
            part.append(x)
    return tuple(np.concatenate(x) if x else np.empty(0, t) for x, t in zip(out, (int, int, float)))


def _dealt_near(x: np.ndarray, n: int, rounds: int = 2) -> np.ndarray:
    """For each row of ``x`` which of ``n`` middles, at first rows of ``x``, is near."""
    middles = x[np.linspace(0, len(x) - 1, n).astype(int)]
    for last in range(rounds)[::-1]:
        half = (middles * middles).sum(1) / 2
        label = np.concatenate([np.argmax(x[s:s + 8192] @ middles.T - half, axis=1) for s in range(0, len(x), 8192)])
        if last:
            order, sizes = np.argsort(label, kind="stable"), np.bincount(label, minlength=n)
            some = sizes > 0
            middles[some] = np.add.reduceat(x[order], (np.cumsum(sizes) - sizes)[some], axis=0) / sizes[some, None]
    return label


def near_cells(x: np.ndarray, size: int = CELL) -> tuple[np.ndarray, np.ndarray]:
    """``order, starts``: the rows of ``x`` in cells of about ``size`` (twice as many at most) that lie
    near one another, dealt in two steps, and where the cells start in that order."""
    x = x.astype("float32")
    n = max(1, round((len(x) / size) ** 0.5))
    top = _dealt_near(x, n)
    order, starts, at = [], [], 0
    for part in np.split(np.argsort(top, kind="stable"), np.cumsum(np.bincount(top, minlength=n))[:-1]):
        if len(part):
            label = _dealt_near(x[part], max(1, round(len(part) / size)))
            order.append(part[np.argsort(label, kind="stable")])
            for m in np.bincount(label):
                starts.append(np.arange(at, at + m, 2 * size))
                at += m
    return np.concatenate(order), np.concatenate(starts)


def best_near(one: np.ndarray, two: np.ndarray, k: int, digits: int, min_score: float | None = None,
              floors: np.ndarray | None = None, own: np.ndarray | None = None):
    """:func:`best_products` for rows ``two`` of one length.  A cell's vectors lie in a cone, so a row
    whose angle to the axis is more than the cone's and that of its bound together needs none of them."""
    place, starts = near_cells(two)
    two = two[place]
    ends, sizes, reach = np.r_[starts[1:], len(two)], np.diff(np.r_[starts, len(two)]), np.sqrt((two[0] * two[0]).sum())
    axes = np.add.reduceat(two, starts, axis=0)
    long = np.sqrt((axes * axes).sum(1, keepdims=True))
    axes = np.divide(axes, long, out=two[starts] / reach, where=long > 1e-9 * reach)
    widths = np.arccos(np.clip(np.minimum.reduceat(np.einsum("ij,ij->i", two, np.repeat(axes, sizes, axis=0)), starts) / reach, -1, 1)) + ANGLE_SLACK
    lengths = np.sqrt((one * one).sum(1))
    noise = SINGLE * max(1, one.shape[1]) * lengths * reach + 2.2 * 10.0 ** -digits
    small, other, thin = one.astype("float32"), two.astype("float32"), axes.astype("float32")
    # a row's angle to an axis is to be at most the cone's and that of its bound together (each up to a
    # right angle): dots >= cos(a) cos(b) - sin(a) sin(b), as one product; a wider cone is met by all
    broad = widths > np.pi / 2
    cones = np.column_stack([thin, np.where(broad, ALWAYS, -np.cos(widths)), np.where(broad, ALWAYS, np.sin(widths))]).astype("float32")
    turn = near_cells(one)[0] if len(one) > CELL else np.arange(len(one))       # rows met together are near one another
    step, out = max(ROW_CHUNK, CONE_CELLS // len(starts)), [[], [], []]
    for s0 in range(0, len(one), step):
        rows = turn[s0:s0 + step]
        n, q = len(rows), small[rows]
        low = np.full(n, -np.inf) if min_score is None else np.full(n, min_score)
        if floors is not None:
            low = np.maximum(low, floors[rows])
        bound = low - noise[rows]
        if floors is None:
            # a first bound: the kth best in the cells next to the nearest one
            nearest = np.concatenate([(q[x:x + 1024] @ thin.T).argmax(1) for x in range(0, n, 1024)])
            order = np.argsort(nearest, kind="stable")
            for some in np.split(order, 1 + np.flatnonzero(np.diff(nearest[order]))):
                near = thin @ thin[nearest[some[0]]]
                by = np.argpartition(-near, FIRST_CELLS)[:FIRST_CELLS] if len(near) > FIRST_CELLS else range(len(near))
                raw = q[some] @ other[np.concatenate([np.arange(starts[x], ends[x]) for x in by])].T
                if raw.shape[1] > k + 1:
                    kth = np.partition(raw, -k - 1, axis=1)[:, -k - 1]
                    bound[some] = np.maximum(bound[some], kth - 2 * noise[rows[some]])
        unit = np.where(lengths[rows] > 0, lengths[rows], 1.0)
        share = np.clip(bound / (unit * reach), 0.0, 1.0)
        asked = np.column_stack([q / unit[:, None], np.where(share > 0, share, -ALWAYS), np.where(share > 0, np.sqrt(1 - share * share), 2 * ALWAYS)])
        meets = cones @ asked.astype("float32").T >= 0
        bound = bound.astype("float32")
        kept, new, waiting = (np.empty(0, int), np.empty(0, int), np.empty(0)), [], 0
        cells = np.flatnonzero(meets.any(1))
        for cell in cells:
            at, c0, c1 = np.flatnonzero(meets[cell]), starts[cell], ends[cell]
            passing = np.flatnonzero(q[at] @ other[c0:c1].T >= bound[at, None])
            new.append((at[passing // (c1 - c0)], c0 + passing % (c1 - c0)))
            waiting += len(passing)
            if waiting > max(PAIR_SLICE, 4 * k * n) or cell == cells[-1]:
                r, c = (np.concatenate(x) for x in zip(*new))
                score = pair_products(one[rows], two, r, c)
                count = np.round(score, FIXED_DIGITS) > min_score if min_score is not None else ~np.isnan(score)
                if own is not None:
                    count &= place[c] != own[rows[r]]
                found = r[count], place[c[count]], round_half_away(score[count], digits)
                *kept, kth = _cut(*(np.concatenate(x) for x in zip(kept, found)), k, n)
                new, waiting = [], 0
                bound = np.maximum(bound, (np.maximum(low, kth) - noise[rows]).astype("float32"))
        for part, x in zip(out, (rows[kept[0]], kept[1], kept[2])):
            part.append(x)
    return tuple(np.concatenate(x) if x else np.empty(0, t) for x, t in zip(out, (int, int, float)))
