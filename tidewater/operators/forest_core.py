"""Growing and reading regression trees on binned rows, with NumPy: what the tasks of ``forest`` do.

A tree is four arrays, a node each: the feature it is split by (-1: a leaf), the last bin that goes left, the number of its
left child (the right one is next) and the mean label of its rows. Nodes are numbered level by level and every level draws its features
in turn, so a tree of less depth is the beginning of a deeper one with the same draws.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

#: Bins of a feature at most; a bin's number fits its bits.
BINS, BIN_BITS = 32, 5


def binned(x: np.ndarray, points: list[np.ndarray]) -> np.ndarray:
    """The bin of every value: how many split points of its feature lie below it."""
    out = np.empty(x.shape, np.uint8)
    for f, p in enumerate(points):
        out[:, f] = np.searchsorted(p, x[:, f], side="left")
    return out


def bootstrap(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is drawn for a tree."""
    return np.random.default_rng([seed, tree, block]).poisson(1.0, n).astype(np.float64)


def drawn_features(rng: np.random.Generator, nodes: int, width: int, subset: int) -> np.ndarray:
    """``subset`` different features for every node."""
    if subset >= width:
        return np.tile(np.arange(width), (nodes, 1))
    return rng.random((nodes, width)).argpartition(subset - 1, axis=1)[:, :subset]


def starts(ids: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])


def best_cuts(code: np.ndarray, weight: np.ndarray, total: np.ndarray, tw: np.ndarray, ts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per node the largest gain of a cut and the last bin left of it; gain -inf where a node has one bin.

    ``code`` is node * BINS + bin, ascending; ``weight`` and ``total`` are the rows' counts and sums of labels, ``tw`` and ``ts`` the nodes'.
    """
    nodes = len(tw)
    gain, cut = np.full(nodes, -np.inf), np.zeros(nodes, np.int64)
    node = code >> BIN_BITS
    at = np.flatnonzero((code[1:] != code[:-1]) & (node[1:] == node[:-1]))
    if len(at):
        cw, cs = np.cumsum(weight), np.cumsum(total)
        first = np.searchsorted(node, np.arange(nodes))
        own = node[at]
        before = first[own] - 1
        lw = cw[at] - np.where(before >= 0, cw[before], 0.0)
        ls = cs[at] - np.where(before >= 0, cs[before], 0.0)
        rw, rs = tw[own] - lw, ts[own] - ls
        g = ls * ls / lw + rs * rs / rw - (ts * ts / tw)[own]
        seg = starts(own)
        top = np.maximum.reduceat(g, seg)
        hit = np.flatnonzero(g == np.repeat(top, np.diff(np.r_[seg, len(own)])))[::-1]
        gain[own[seg]] = top
        cut[own[hit]] = code[at[hit]] & (BINS - 1)  # the first of equal ones is written last
    return gain, cut


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int | None, rng: np.random.Generator, subset: int, least: float):
    """The tree of rows with bins, labels and counts (all > 0); nodes are split while the squared error falls by more than ``least``."""
    n, width = bins.shape
    flat, wy = bins.ravel(), w * y
    shift = np.int64(max(1, int(n).bit_length()))
    mask = (np.int64(1) << shift) - 1
    rows, node = np.arange(n), np.zeros(n, np.int64)  # rows ordered by their node
    feats, cuts, lefts, values = [], [], [], []
    made, nodes, level = 1, 1, 0
    while True:
        begin = starts(node)
        tw, ts = np.add.reduceat(w[rows], begin), np.add.reduceat(wy[rows], begin)
        feat, cut, left = np.full(nodes, -1, np.int16), np.zeros(nodes, np.uint8), np.zeros(nodes, np.int32)
        feats.append(feat), cuts.append(cut), lefts.append(left), values.append(ts / tw)
        if depth is not None and level >= depth:
            break
        drawn = drawn_features(rng, nodes, width, subset)
        of_row = y[rows]
        mixed = np.minimum.reduceat(of_row, begin) < np.maximum.reduceat(of_row, begin)
        if not mixed.any():
            break
        ids, again, keep = np.flatnonzero(mixed), np.cumsum(mixed) - 1, mixed[node]
        rows, node = rows[keep], again[node[keep]]
        tw, ts, drawn = tw[ids], ts[ids], drawn[ids]
        best, by, upto = np.full(len(ids), least), np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.int64)
        place, base, wr, wyr = np.arange(len(rows)), rows * width, w[rows], wy[rows]
        for f in drawn.T:
            key = ((node * BINS + flat[base + f[node]]) << shift) | place
            key.sort()
            order = key & mask
            gain, last = best_cuts(key >> shift, wr[order], wyr[order], tw, ts)
            better = gain > best
            best[better], by[better], upto[better] = gain[better], f[better], last[better]
        split = by >= 0
        if not split.any():
            break
        rank = np.cumsum(split) - 1
        feat[ids[split]], cut[ids[split]], left[ids[split]] = by[split], upto[split], made + 2 * rank[split]
        keep = split[node]
        rows, node = rows[keep], node[keep]
        child = 2 * rank[node] + (flat[rows * width + by[node]] > upto[node])
        key = (child << shift) | np.arange(len(rows))
        key.sort()
        rows, node = rows[key & mask], child[key & mask]
        nodes = 2 * int(split.sum())
        made, level = made + nodes, level + 1
    return np.concatenate(feats), np.concatenate(cuts), np.concatenate(lefts), np.concatenate(values)


def reached(tree, bins: np.ndarray) -> np.ndarray:
    """The leaf of every row."""
    return _walk(tree, bins, [None])[0]


def predicted(tree, bins: np.ndarray, depths: list[int | None]) -> np.ndarray:
    """A row of predictions for each depth at which the tree is cut (None: not at all)."""
    return tree[3][_walk(tree, bins, depths)]


def _walk(tree, bins: np.ndarray, depths: list[int | None]) -> np.ndarray:
    feat, cut, left, _ = tree
    n, width = bins.shape
    flat, at, live, level = bins.ravel(), np.zeros(n, np.int64), np.arange(n), 0
    out = np.empty((len(depths), n), np.int64)
    while len(live):
        for i, d in enumerate(depths):
            if d == level:
                out[i] = at
        f = feat[at[live]]
        live, f = live[f >= 0], f[f >= 0]
        here = at[live]
        at[live] = left[here] + (flat[live * width + f] > cut[here])
        level += 1
    for i, d in enumerate(depths):
        if d is None or d >= level:
            out[i] = at
    return out


# ---- what tasks do: functions over the Arrow batches of a partition

#: Rows of a block at most.
BLOCK = 8192


def _bytes(batch, name: str, i: int, kind) -> np.ndarray:
    return np.frombuffer(batch.column(name)[i].as_buffer(), kind)


def _rows(batch, *names: str):
    return zip(*(batch.column(c).to_pylist() for c in names), strict=True)


def few_values(most: int):
    """(list of numbers) -> (feature, its values in the partition, or null where they are more than ``most``)."""
    def each(batches):
        found: dict[int, np.ndarray | None] = {}
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for f in range(x.shape[1]):
                if found.get(f, ()) is not None:
                    u = np.unique(np.r_[found.get(f, x[:0, f]), x[:, f]])
                    u = u[~np.isnan(u)]
                    found[f] = u if len(u) <= most else None
        yield pa.RecordBatch.from_arrays([pa.array([*found], pa.int32()), pa.array([None if v is None else v.tolist() for v in found.values()], pa.list_(pa.float64()))], ["feature", "held"])
    return each


def packed(points: list[np.ndarray], centre: float):
    """(list of numbers, number of the row, label) -> blocks of binned rows; labels are taken from ``centre``."""
    def each(batches):
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            ids, y = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False) - centre
            for a in range(0, len(x), BLOCK):
                z = slice(a, a + BLOCK)
                yield _batch(BLOCKS, [(block, len(x[z]), binned(x[z], points).tobytes(), ids[z].tobytes(), y[z].tobytes())])
                block += 1
    return each


BLOCKS = {"block": pa.int64(), "n": pa.int64(), "bins": pa.binary(), "ids": pa.binary(), "y": pa.binary()}
COUNTS = {"tree": pa.int64(), "node": pa.int64(), "part": pa.int64(), "counts": pa.binary()}
CUTS = {"tree": pa.int64(), "node": pa.int64(), "feature": pa.int64(), "cut": pa.int64(), "w": pa.float64(), "s": pa.float64(),
        "left_n": pa.int64(), "left_w": pa.float64(), "left_s": pa.float64(), "right_n": pa.int64(), "right_w": pa.float64(), "right_s": pa.float64()}
DEALT = {"tree": pa.int64(), "node": pa.int64(), "kind": pa.int64(), "block": pa.int64(), "n": pa.int64(), "bins": pa.binary(), "more": pa.binary(), "w": pa.binary()}
SUMS = {"span": pa.int64(), "block": pa.int64(), "part": pa.int64(), "n": pa.int64(), "at": pa.binary(), "sums": pa.binary()}


def _batch(schema: dict, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, schema.values(), strict=True)], [*schema])


def whole_trees(train, asked, seed: int, subset: int, depths: list[int | None], limit: int | None, least: float):
    """(span, first tree, end) -> sums of the trees' predictions for every block of ``asked``; both are broadcast blocks: (block, bins, y)."""
    def each(batches):
        t, a = train.value, asked.value
        bins, y, blocks = np.concatenate([b for _, b, _ in t]), np.concatenate([v for _, _, v in t]), [(k, len(v)) for k, _, v in t]
        wanted = np.concatenate([bins[:0], *(b for _, b, _ in a)])
        for batch in batches:
            for span, first, end in _rows(batch, "span", "first", "end"):
                total = np.zeros((len(depths), len(wanted)))
                for tree in range(first, end):
                    w = np.concatenate([bootstrap(seed, tree, k, n) for k, n in blocks])
                    if (w > 0).any():
                        grown = grow(bins[w > 0], y[w > 0], w[w > 0], limit, np.random.default_rng([seed, tree, 0]), subset, least)
                        total += predicted(grown, wanted, depths)
                place = 0
                for k, b, _ in a:
                    yield _batch(SUMS, [(span, k, first, len(b), b"", total[:, place:place + len(b)].tobytes())])
                    place += len(b)
    return each


def node_counts(tops: dict, seed: int, width: int, subset: int):
    """Blocks -> rows, draws and labels of every bin of the features drawn for the open nodes of each tree, summed over the partition."""
    def each(batches):
        held: dict[int, np.ndarray] = {}
        drawn = {t: np.stack([node_features(seed, t, v, width, subset) for v in nodes]) for t, (_, nodes) in tops.items()}
        for batch in batches:
            for i, (block, n) in enumerate(_rows(batch, "block", "n")):
                bins, y = _bytes(batch, "bins", i, np.uint8).reshape(n, width), _bytes(batch, "y", i, np.float64)
                for t, (top, nodes) in tops.items():
                    w = bootstrap(seed, t, block, n)
                    number = np.full(len(top[0]), -1)
                    number[nodes] = np.arange(len(nodes))
                    k = number[reached(top, bins)]
                    use = np.flatnonzero((w > 0) & (k >= 0))
                    k, v, wy = k[use], w[use], w[use] * y[use]
                    c = held.setdefault(t, np.zeros((len(nodes), drawn[t].shape[1], BINS, 3)))
                    for j in range(c.shape[1]):
                        code = k * BINS + bins[use, drawn[t][k, j]]
                        for s, weights in enumerate((None, v, wy)):
                            c[:, j, :, s] += np.bincount(code, weights, len(nodes) * BINS).reshape(-1, BINS)
        part = TaskContext.get().partitionId()
        for t, c in held.items():
            yield _batch(COUNTS, [(t, int(v), part, c[i].tobytes()) for i, v in enumerate(tops[t][1])])
    return each


def node_features(seed: int, tree: int, node: int, width: int, subset: int) -> np.ndarray:
    return drawn_features(np.random.default_rng([seed, tree, int(node), 1]), 1, width, subset)[0]


def chosen_cuts(seed: int, width: int, subset: int, least: float):
    """Counts, ordered by tree and node -> the best cut of each node (feature -1: none) and what lies left and right of it."""
    def settled(tree, node, counts):
        c = counts.reshape(-1, BINS, 3)
        upto, all_ = np.cumsum(c, axis=1)[:, :-1], c.sum(axis=1)[:, None]
        rest = all_ - upto
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = upto[..., 2] ** 2 / upto[..., 1] + rest[..., 2] ** 2 / rest[..., 1] - all_[..., 2] ** 2 / all_[..., 1]
        gain[(upto[..., 0] == 0) | (rest[..., 0] == 0)] = -np.inf
        j, b = np.unravel_index(gain.argmax(), gain.shape)
        f = int(node_features(seed, tree, node, width, subset)[j]) if gain[j, b] > least else -1
        (ln, lw, ls), (rn, rw, rs) = upto[j, b], rest[j, b]
        return (tree, node, f, int(b), all_[0, 0, 1], all_[0, 0, 2], int(ln), lw, ls, int(rn), rw, rs)

    def each(batches):
        key, total = None, None
        for batch in batches:
            for i, at in enumerate(_rows(batch, "tree", "node")):
                c = _bytes(batch, "counts", i, np.float64)
                if at != key:
                    if key:
                        yield _batch(CUTS, [settled(*key, total)])
                    key, total = at, np.zeros(len(c))
                total = total + c
        if key:
            yield _batch(CUTS, [settled(*key, total)])
    return each


def dealt(tops: dict, seed: int, width: int, asked: bool):
    """Blocks -> the rows of each block that lie in a node, for every tree: those drawn in nodes to be grown, or all that are asked for."""
    def each(batches):
        for batch in batches:
            for i, (block, n) in enumerate(_rows(batch, "block", "n")):
                bins, y = _bytes(batch, "bins", i, np.uint8).reshape(n, width), _bytes(batch, "y", i, np.float64)
                for t, (top, nodes) in tops.items():
                    at = reached(top, bins)
                    w = None if asked else bootstrap(seed, t, block, n)
                    use = np.arange(n) if asked else np.flatnonzero((w > 0) & np.isin(at, nodes))
                    use = use[np.argsort(at[use], kind="stable")]
                    out = []
                    for r in np.split(use, starts(at[use])[1:]) if len(use) else ():
                        more = r.astype(np.int32) if asked else y[r]
                        out.append((t, int(at[r[0]]), int(asked), block, n if asked else len(r), bins[r].tobytes(), more.tobytes(), b"" if asked else w[r].tobytes()))
                    yield _batch(DEALT, out)
    return each


def grown_nodes(tops: dict, span: int, seed: int, width: int, subset: int, depths: list[int | None], limit: int | None, least: float):
    """Dealt rows, ordered by tree, node and kind -> predictions of each tree for the rows that are asked for."""
    def each(batches):
        key, bins, y, w, tree, own = None, [], [], [], None, 0
        for batch in batches:
            for i, (t, node, kind, block, n) in enumerate(_rows(batch, "tree", "node", "kind", "block", "n")):
                if (t, node) != key:
                    key, bins, y, w, tree = (t, node), [], [], [], None
                    own = int(tops[t][2][node])
                b, more = _bytes(batch, "bins", i, np.uint8).reshape(-1, width), batch.column("more")[i].as_buffer()
                if not kind:
                    bins.append(b), y.append(np.frombuffer(more)), w.append(_bytes(batch, "w", i, np.float64))
                    continue
                if tree is None and bins:
                    tree = grow(np.concatenate(bins), np.concatenate(y), np.concatenate(w), None if limit is None else limit - own, np.random.default_rng([seed, t, node]), subset, least)
                    bins, y, w = [], [], []
                found = predicted(tops[t][0], b, depths)
                deeper = [k for k, d in enumerate(depths) if d is None or d >= own]
                if tree is not None and deeper:
                    found[deeper] = predicted(tree, b, [None if depths[k] is None else depths[k] - own for k in deeper])
                yield _batch(SUMS, [(span, block, t, n, bytes(more), found.tobytes())])
    return each


def summed(depths: int):
    """Predictions, ordered by block -> their sum for each block and span."""
    def each(batches):
        key, total = None, None
        for batch in batches:
            for i, (span, block, n) in enumerate(_rows(batch, "span", "block", "n")):
                if (block, span) != key:
                    if key:
                        yield _batch(SUMS, [(key[1], key[0], 0, total.shape[1], b"", total.tobytes())])
                    key, total = (block, span), np.zeros((depths, n))
                at = _bytes(batch, "at", i, np.int32)
                total[:, at if len(at) else slice(None)] += _bytes(batch, "sums", i, np.float64).reshape(depths, -1)
        if key:
            yield _batch(SUMS, [(key[1], key[0], 0, total.shape[1], b"", total.tobytes())])
    return each


def averaged(uses: list[tuple[int, int, int]], depths: int, centre: float):
    """A block's row numbers (span -1), then its sums by span -> (row number, prediction of each setting).

    ``uses`` has for each setting its last span, the place of its depth and its trees.
    """
    def each(batches):
        ids, total = None, None

        def done():
            p = np.stack([total[:span + 1, d].sum(axis=0) / trees + centre for span, d, trees in uses], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
            return pa.RecordBatch.from_arrays([pa.array(ids), lists], ["_row", "predictions"])

        for batch in batches:
            for i, span in enumerate(batch.column("span").to_pylist()):
                if span < 0:
                    if ids is not None:
                        yield done()
                    ids = _bytes(batch, "sums", i, np.int64)
                    total = np.zeros((max(u[0] for u in uses) + 1, depths, len(ids)))
                else:
                    total[span] += _bytes(batch, "sums", i, np.float64).reshape(depths, -1)
        if ids is not None:
            yield done()
    return each
