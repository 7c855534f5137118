"""Histogram gradient boosting of binary trees on Spark, several models in lockstep.

Features are cut into at most ``bins`` quantile bins once; the binned rows are written as packed
blocks (codes by feature, label, weight, fold, row hash and the margins of all models).  A tree
is grown level by level while its nodes are large: one job adds up, for every such node, the
sums of gradients, hessians and rows by (feature, bin); the driver picks the best cut of each
node (tables of nodes x features x bins numbers, whatever the number of rows).  Only the smaller
child of a cut node is added up, its sibling is the parent's table less that.  Nodes of at most
``local_rows`` rows leave this loop: one last job of the tree sends the rows of each to one task,
which grows the rest of that subtree with the same sums and cuts.  So a tree costs as many jobs as it
has levels with large nodes, plus one.  A model of at most ``local_rows`` training rows needs none of this:
one job grows the trees of all such models, each model in one task.

Every job serves all models of a call (the folds of a cross-validation, the points of a grid),
so these cost rows, not jobs.  Margins are kept in the blocks and renewed every ``REBASE`` trees;
in between a task adds the few latest trees to them.  Nothing depends on where a row is: bins,
sampled rows and sums are the same after a task is repeated elsewhere, up to the rounding of sums.

Loss: logistic.  Cut gain and leaf value are the usual second-order ones, with ``l2`` on the leaf
values and ``min_child`` as the least hessian of a child.  Missing values (null or NaN) have a bin of
their own above all others.  Ties of gain go to the first feature and the lowest cut.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episcope.session import cut_lineage, drop_table, ship_package

REBASE = 10              # trees between two renewals of the margins
BLOCK_ROWS = 4_096       # rows of a packed block
LOCAL_ROWS = 20_000      # rows of a node whose subtree one task grows
SLOTS = 512              # nodes whose sums one job collects
KEPT = 1024              # nodes whose sums the driver keeps for their children
LEAST_GAIN = 1e-6

BLOCKS = "block long, n long, codes binary, label binary, weight binary, part binary, uid binary, margin binary"


@dataclass(frozen=True)
class BoostSpec:
    """One model: ``trees`` trees of ``depth``; ``leave_out``: the fold that does not train (None: every row does)."""
    name: str
    trees: int = 100
    depth: int = 6
    rate: float = 0.3
    l2: float = 1.0
    min_child: float = 1.0
    subsample: float = 1.0
    leave_out: int | None = None
    seed: int = 42


@dataclass
class Tree:
    """Nodes as arrays: feature (-1: leaf), bin of the cut, children, value, gain."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """Leaf of each column of ``codes`` (features x rows)."""
        at = np.zeros(codes.shape[1], dtype=np.int64)
        rows = np.arange(codes.shape[1])
        while len(rows):
            f = self.feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            node = at[rows]
            at[rows] = np.where(codes[f, rows] <= self.cut[node], self.left[node], self.right[node])
        return at


@dataclass
class BoostedModel:
    spec: BoostSpec
    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def importance(self) -> dict[str, float]:
        """Share of each feature in the total gain (all zero for a model without cuts)."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            np.add.at(total, t.feature[t.feature >= 0], t.gain[t.feature >= 0])
        return dict(zip(self.features, (total / (total.sum() or 1.0)).tolist()))


# ---------------------------------------------------------------- bins and blocks

def bin_edges(df: DataFrame, features: list[str], bins: int = 64) -> list[list[float]]:
    """Upper edges of the bins of each feature: distinct approximate quantiles of the values present."""
    at = "array(" + ", ".join(f"{i / bins}D" for i in range(1, bins)) + ")"
    row = df.agg(*[F.expr(f"percentile_approx(nullif(double(`{f}`), double('NaN')), {at}, 20000)").alias(f"q{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(q or [])) for q in row]


def codes_of(batch: pa.RecordBatch, features: list[str], edges: list[list[float]]) -> np.ndarray:
    """Bin numbers, features x rows: how many edges lie below the value (missing: one beyond the last bin)."""
    out = np.empty((len(features), batch.num_rows), dtype=np.uint8)
    for i, f in enumerate(features):
        x = batch.column(batch.schema.get_field_index(f)).cast(pa.float64()).to_numpy(zero_copy_only=False)
        out[i] = np.searchsorted(edges[i], x, side="left")
        out[i][np.isnan(x)] = len(edges[i]) + 1
    return out


def _pack(features, edges, label, models):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                c = b.slice(at, BLOCK_ROWS)
                n = c.num_rows

                def column(name, kind):
                    return np.ascontiguousarray(c.column(c.schema.get_field_index(name)).to_numpy(zero_copy_only=False), dtype=kind)
                uid = column("_uid", np.int64)
                margin = np.repeat(np.array([m.base for m in models], dtype=np.float64)[:, None], n, axis=1)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([int(uid[0])], pa.int64()), "n": pa.array([n], pa.int64()),
                    "codes": [codes_of(c, features, edges).tobytes()], "label": [column(label, np.float64).tobytes()],
                    "weight": [column("_weight", np.float64).tobytes()], "part": [column("_part", np.int32).tobytes()],
                    "uid": [uid.tobytes()], "margin": [margin.tobytes()]}, schema=_ARROW_BLOCKS)
    return run


_ARROW_BLOCKS = pa.schema([("block", pa.int64()), ("n", pa.int64())]
                          + [(c, pa.binary()) for c in ("codes", "label", "weight", "part", "uid", "margin")])


class _Block:
    """A packed block as arrays."""

    def __init__(self, row: dict, features: int, models: int | None = None):
        def array(name, kind):
            return np.frombuffer(row[name], dtype=kind)
        self.n = row["n"]
        self.codes = array("codes", np.uint8).reshape(features, self.n)
        self.label, self.weight = array("label", np.float64), array("weight", np.float64)
        self.part, self.uid = array("part", np.int32), array("uid", np.int64)
        if models is not None:
            self.margin = array("margin", np.float64).reshape(models, self.n)

    def margin_of(self, model: int, rate: float, latest: list[Tree]) -> np.ndarray:
        out = self.margin[model]
        for t in latest:
            out = out + rate * t.value[t.leaves(self.codes)]
        return out

    def training(self, spec: BoostSpec, tree: int) -> np.ndarray:
        """Rows that train this tree of the model."""
        rows = self.of_model(spec)
        return rows[_sampled(self.uid[rows], spec, tree)]

    def of_model(self, spec: BoostSpec) -> np.ndarray:
        """Rows that may train any tree of the model."""
        return np.arange(self.n) if spec.leave_out is None else np.flatnonzero((self.part >= 0) & (self.part != spec.leave_out))


def _sampled(uid: np.ndarray, spec: BoostSpec, tree: int) -> np.ndarray:
    """Those of the rows ``uid`` that train this tree."""
    return np.flatnonzero(_uniform(uid, spec.seed * 1_000_003 + tree) < spec.subsample) if spec.subsample < 1 else np.arange(len(uid))


def _uniform(uid: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) for each row hash, another one for each salt."""
    x = uid.view(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def _blocks(batches, features: int, models: int | None = None):
    for b in batches:
        for row in b.to_pylist():
            yield _Block(row, features, models)


# ---------------------------------------------------------------- sums and cuts

def sums(codes: np.ndarray, slot: np.ndarray, slots: int, bins: int, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(slots, features, bins, 3): gradient, hessian and rows by slot, feature and bin."""
    out = np.empty((slots, len(codes), bins, 3))
    base = slot * bins
    for f in range(len(codes)):
        at = base + codes[f]
        for i, weights in enumerate((g, h, None)):
            out[:, f, :, i] = np.bincount(at, weights=weights, minlength=slots * bins).reshape(slots, bins)
    return out


def best_cuts(table: np.ndarray, l2: float, min_child: float):
    """For each slot of ``table``: (gain, feature, bin, left sums, right sums) of the best cut
    "code <= bin"; gain 0 where none helps."""
    left = np.cumsum(table, axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left

    def strength(x):
        return x[..., 0] ** 2 / (x[..., 1] + l2)
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = strength(left) + strength(right) - strength(whole)
    bad = (left[..., 1] < min_child) | (right[..., 1] < min_child) | (left[..., 2] < 0.5) | (right[..., 2] < 0.5) | ~np.isfinite(gain)
    gain = np.where(bad, 0.0, gain).reshape(len(table), -1)
    best = gain.argmax(axis=1)
    f, b = best // table.shape[2], best % table.shape[2]
    i = np.arange(len(table))
    return gain[i, best], f, b, left[i, f, b], right[i, f, b]


class _Growing:
    """A tree under construction."""

    def __init__(self):
        self.nodes: list[list] = [[-1, 0, 0, 0, 0.0, 0.0]]

    def leaf(self, node: int, g: float, h: float, l2: float) -> None:
        self.nodes[node][4] = -g / (h + l2) if h + l2 > 0 else 0.0

    def cut(self, node: int, feature: int, at: int, gain: float) -> tuple[int, int]:
        left = len(self.nodes)
        self.nodes[node][:4] = [int(feature), int(at), left, left + 1]
        self.nodes[node][5] = float(gain)
        self.nodes += [[-1, 0, 0, 0, 0.0, 0.0], [-1, 0, 0, 0, 0.0, 0.0]]
        return left, left + 1

    def graft(self, node: int, tree: Tree) -> None:
        """Put ``tree`` in the place of a leaf: its root at ``node``, the others behind."""
        shift = len(self.nodes) - 1

        def child(x):
            return int(x) + shift if x > 0 else 0
        rows = [[int(a), int(b), child(c), child(d), float(e), float(f)]
                for a, b, c, d, e, f in zip(tree.feature, tree.cut, tree.left, tree.right, tree.value, tree.gain)]
        self.nodes[node] = rows[0]
        self.nodes += rows[1:]

    def tree(self) -> Tree:
        cols = list(zip(*self.nodes))
        return Tree(*[np.array(c, dtype=np.int64) for c in cols[:4]], *[np.array(c) for c in cols[4:]])


def grow(codes: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, bins: int, l2: float, min_child: float) -> Tree:
    """The whole tree over these rows, level by level."""
    out = _Growing()
    rows, slot, nodes = np.arange(codes.shape[1]), np.zeros(codes.shape[1], dtype=np.int64), [0]
    out.leaf(0, g.sum(), h.sum(), l2)
    for _ in range(depth):
        # a node whose hessian is below that of two children has no cut: its rows leave here
        open_ = np.bincount(slot, h[rows], len(nodes)) >= 2 * min_child * (1 - 1e-9)
        if not open_.all():
            to = np.cumsum(open_) - 1
            rows, slot, nodes = rows[open_[slot]], to[slot[open_[slot]]], [n for n, o in zip(nodes, open_) if o]
            if not nodes:
                break
        gain, f, b, left, right = best_cuts(sums(codes[:, rows], slot, len(nodes), bins, g[rows], h[rows]), l2, min_child)
        following, to = [], np.full((len(nodes), 2), -1, dtype=np.int64)
        for i in np.flatnonzero(gain > LEAST_GAIN):
            for side, (child, s) in enumerate(zip(out.cut(nodes[i], f[i], b[i], gain[i]), (left[i], right[i]))):
                out.leaf(child, s[0], s[1], l2)
                to[i, side] = len(following)
                following.append(child)
        if not following:
            break
        slot = to[slot, (codes[f[slot], rows] > b[slot]).astype(np.int64)]
        rows, slot, nodes = rows[slot >= 0], slot[slot >= 0], following
    return out.tree()


# ---------------------------------------------------------------- jobs

def _gradients(block: _Block, m: int, spec: BoostSpec, latest: list[Tree], tree: int):
    """(training rows, gradients, hessians) of one model in one block."""
    rows = block.training(spec, tree)
    p = 1 / (1 + np.exp(-block.margin_of(m, spec.rate, latest)[rows]))
    w = block.weight[rows]
    return rows, w * (p - block.label[rows]), w * p * (1 - p)


def _sum_job(blocks: DataFrame, models, latest, partial, wanted, tree: int, bins: int) -> dict:
    """Sums of the wanted nodes: model -> list of nodes gives (model, node) -> table."""
    features = len(models[0].features)
    specs = [m.spec for m in models]

    def add(batches):
        tables: dict = {}
        for block in _blocks(batches, features, len(specs)):
            for m, nodes in wanted.items():
                rows, g, h = _gradients(block, m, specs[m], latest[m], tree)
                slot_of = np.full(len(partial[m].feature), -1, dtype=np.int64)
                slot_of[nodes] = np.arange(len(nodes))
                slot = slot_of[partial[m].leaves(block.codes[:, rows])]
                ok = slot >= 0
                found = sums(block.codes[:, rows[ok]], slot[ok], len(nodes), bins, g[ok], h[ok])
                tables[m] = tables[m] + found if m in tables else found
        rows = [(m, node, table.tobytes()) for m, t in tables.items() for node, table in zip(wanted[m], t)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.binary())], names=["model", "node", "sums"])

    def total(group: pa.Table) -> pa.Table:
        both = sum(np.frombuffer(x, dtype=np.float64) for x in sorted(group["sums"].to_pylist()))
        return pa.table({"model": group["model"].slice(0, 1).combine_chunks(), "node": group["node"].slice(0, 1).combine_chunks(),
                         "sums": pa.array([both.tobytes()], pa.binary())})

    kind = "model int, node int, sums binary"
    out = blocks.mapInArrow(add, kind).groupBy("model", "node").applyInArrow(total, kind).collect()
    return {(r["model"], r["node"]): np.frombuffer(r["sums"], dtype=np.float64).reshape(features, bins, 3) for r in out}


TREE_COLUMNS = ("feature", "cut", "left", "right", "value", "gain")


def _local_job(blocks: DataFrame, models, latest, partial, wanted, tree: int, bins: int) -> dict:
    """Subtrees of the wanted nodes (model -> {node: levels left}), each grown in one task."""
    features = len(models[0].features)
    specs = [m.spec for m in models]

    def send(batches):
        for block in _blocks(batches, features, len(specs)):
            out = []
            for m, nodes in wanted.items():
                rows, g, h = _gradients(block, m, specs[m], latest[m], tree)
                at = partial[m].leaves(block.codes[:, rows])
                order = np.argsort(at, kind="stable")
                for node in nodes:
                    lo, hi = np.searchsorted(at[order], (node, node + 1))
                    own = order[lo:hi]
                    if len(own):
                        out.append((m, node, int(block.uid[0]), block.codes[:, rows[own]].tobytes(), g[own].tobytes(), h[own].tobytes()))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 3))],
                                                 names=["model", "node", "block", "codes", "g", "h"])

    def subtree(group: pa.Table) -> pa.Table:
        order = np.argsort(group["block"].to_numpy(), kind="stable")
        m, node = group["model"][0].as_py(), group["node"][0].as_py()
        parts = [[np.frombuffer(group[c][int(i)].as_py(), dtype=k) for i in order] for c, k in (("codes", np.uint8), ("g", float), ("h", float))]
        codes = np.concatenate([c.reshape(features, -1) for c in parts[0]], axis=1)
        spec = specs[m]
        t = grow(codes, np.concatenate(parts[1]), np.concatenate(parts[2]), wanted[m][node], bins, spec.l2, spec.min_child)
        return pa.table({"model": pa.array([m], pa.int32()), "node": pa.array([node], pa.int32()),
                         **{c: pa.array([getattr(t, c).tobytes()], pa.binary()) for c in TREE_COLUMNS}})

    kind = "model int, node int, " + ", ".join(f"{c} binary" for c in TREE_COLUMNS)
    rows = blocks.mapInArrow(send, "model int, node int, block long, codes binary, g binary, h binary") \
        .groupBy("model", "node").applyInArrow(subtree, kind).collect()
    return {(r["model"], r["node"]): Tree(*[np.frombuffer(r[c], dtype=np.int64 if i < 4 else np.float64) for i, c in enumerate(TREE_COLUMNS)])
            for r in rows}


def _small_models(blocks: DataFrame, models, wanted: list[int], bins: int) -> None:
    """All trees of the wanted models, of which each has few training rows: one job sends the rows of each
    to one task, which grows its trees one after the other."""
    features = len(models[0].features)
    specs = {m: models[m].spec for m in wanted}
    bases = {m: models[m].base for m in wanted}

    def send(batches):
        for block in _blocks(batches, features):
            out = []
            for m, spec in specs.items():
                rows = block.of_model(spec)
                if len(rows):
                    out.append((m, int(block.uid[0]), block.codes[:, rows].tobytes(), block.label[rows].tobytes(),
                                block.weight[rows].tobytes(), block.uid[rows].tobytes()))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), *[pa.binary()] * 4))],
                                                 names=["model", "block", "codes", "label", "weight", "uid"])

    def boost(group: pa.Table) -> pa.Table:
        order = np.argsort(group["block"].to_numpy(), kind="stable")
        m = group["model"][0].as_py()
        spec = specs[m]
        codes = np.concatenate([np.frombuffer(group["codes"][int(i)].as_py(), dtype=np.uint8).reshape(features, -1) for i in order], axis=1)
        label, weight, uid = (np.concatenate([np.frombuffer(group[c][int(i)].as_py(), dtype=k) for i in order])
                              for c, k in (("label", np.float64), ("weight", np.float64), ("uid", np.int64)))
        margin, trees = np.full(len(label), bases[m]), []
        for tree in range(spec.trees):
            rows = _sampled(uid, spec, tree)
            p = 1 / (1 + np.exp(-margin[rows]))
            w = weight[rows]
            trees.append(grow(codes[:, rows], w * (p - label[rows]), w * p * (1 - p), spec.depth, bins, spec.l2, spec.min_child))
            margin = margin + spec.rate * trees[-1].value[trees[-1].leaves(codes)]
        return pa.table({"model": pa.array([m] * len(trees), pa.int32()), "tree": pa.array(range(len(trees)), pa.int32()),
                         **{c: pa.array([getattr(t, c).tobytes() for t in trees], pa.binary()) for c in TREE_COLUMNS}})

    kind = "model int, tree int, " + ", ".join(f"{c} binary" for c in TREE_COLUMNS)
    # a task for each model: ranges, as hashes of few numbers would collide
    rows = blocks.mapInArrow(send, "model int, block long, codes binary, label binary, weight binary, uid binary") \
        .repartitionByRange(len(wanted), "model").groupBy("model").applyInArrow(boost, kind).collect()
    for r in sorted(rows, key=lambda r: (r["model"], r["tree"])):
        models[r["model"]].trees.append(Tree(*[np.frombuffer(r[c], dtype=np.int64 if i < 4 else np.float64) for i, c in enumerate(TREE_COLUMNS)]))


def _small_held_out(blocks: DataFrame, models, wanted: list[int], stages: list[int]) -> DataFrame:
    """As :func:`_held_out`, for every stage, of models whose trees are all there."""
    features = len(models[0].features)
    own = {m: models[m] for m in wanted if models[m].spec.leave_out is not None}

    def run(batches):
        for block in _blocks(batches, features):
            for m, model in own.items():
                rows = np.flatnonzero(block.part == model.spec.leave_out)
                if not len(rows):
                    continue
                codes, margin = block.codes[:, rows], np.full(len(rows), model.base)
                for i in range(max(stages) + 1):
                    if i in stages:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), x), pa.int32()) for x in (m, i, model.spec.leave_out)]
                            + [pa.array(block.label[rows]), pa.array(1 / (1 + np.exp(-margin)))],
                            names=["model", "trees", "fold", "label", "probability"])
                    if i < len(model.trees):
                        margin = margin + model.spec.rate * model.trees[i].value[model.trees[i].leaves(codes)]

    return cut_lineage(blocks.mapInArrow(run, "model int, trees int, fold int, label double, probability double"), "held-out")


def _next_trees(blocks, models, active, latest, tree, bins, rows_of, local_rows) -> dict[int, Tree]:
    """One more tree for every active model."""
    growing = {m: _Growing() for m in active}
    large = {m: [0] for m in active if rows_of[m] > local_rows}
    small: dict[int, dict[int, int]] = {m: {0: models[m].spec.depth} for m in active if m not in large}
    known: dict = {}                         # (model, node) -> sums, of nodes whose children may follow
    asked = {m: [0] for m in large}
    derived: dict = {}                       # (model, node) -> (parent, sibling): table by subtraction
    level = 0
    while large:
        partial = {m: growing[m].tree() for m in large}
        todo, tables = [(m, n) for m, nodes in asked.items() for n in nodes], {}
        for i in range(0, len(todo), SLOTS):
            wanted: dict[int, list[int]] = {}
            for m, n in todo[i:i + SLOTS]:
                wanted.setdefault(m, []).append(n)
            tables |= _sum_job(blocks, models, latest, partial, wanted, tree, bins)
        nothing = np.zeros((len(models[0].features), bins, 3))
        tables = {k: tables.get(k, nothing) for k in todo}
        tables |= {k: known[parent] - tables[sibling] for k, (parent, sibling) in derived.items()}
        known, asked, derived, following = tables if len(tables) <= KEPT else {}, {}, {}, {}
        level += 1
        for m, nodes in large.items():
            spec = models[m].spec
            left_levels = spec.depth - level
            gain, f, b, lefts, rights = best_cuts(np.stack([tables[m, n] for n in nodes]), spec.l2, spec.min_child)
            for i, node in enumerate(nodes):
                if level == 1:
                    whole = tables[m, node][0].sum(axis=0)
                    growing[m].leaf(node, whole[0], whole[1], spec.l2)
                if gain[i] <= LEAST_GAIN:
                    continue
                children = growing[m].cut(node, f[i], b[i], gain[i])
                big = []
                for child, s in zip(children, (lefts[i], rights[i])):
                    growing[m].leaf(child, s[0], s[1], spec.l2)
                    if left_levels > 0 and s[2] > local_rows:
                        big.append((child, s[2]))
                    elif left_levels > 0:
                        small.setdefault(m, {})[child] = left_levels
                following.setdefault(m, []).extend(c for c, _ in big)
                if len(big) == 2 and (m, node) in known:
                    (less, _), (more, _) = sorted(big, key=lambda c: c[1])
                    asked.setdefault(m, []).append(less)
                    derived[m, more] = (m, node), (m, less)
                else:
                    asked.setdefault(m, []).extend(c for c, _ in big)
        large = {m: n for m, n in following.items() if n}
        asked = {m: n for m, n in asked.items() if n}
    if small:
        partial = {m: growing[m].tree() for m in small}
        for (m, node), t in sorted(_local_job(blocks, models, latest, partial, small, tree, bins).items(), key=lambda x: x[0]):
            growing[m].graft(node, t)
    return {m: growing[m].tree() for m in active}


def _rebased(blocks: DataFrame, models, latest) -> DataFrame:
    """The blocks with the latest trees in their margins, written anew."""
    features, rates = len(models[0].features), [m.spec.rate for m in models]

    def run(batches):
        for b in batches:
            new = []
            for row in b.to_pylist():
                block = _Block(row, features, len(rates))
                new.append(np.stack([block.margin_of(m, r, latest[m]) for m, r in enumerate(rates)]).tobytes())
            at = b.schema.get_field_index("margin")
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(at)], pa.array(new, pa.binary())], names=b.schema.names)

    return cut_lineage(blocks.mapInArrow(run, BLOCKS), "margins")


def _held_out(blocks: DataFrame, models, numbers: list[int], trees: int) -> DataFrame:
    """(model, trees, fold, label, probability) of the rows that each model leaves out, from renewed margins."""
    features, left_out = len(models[0].features), [m.spec.leave_out for m in models]

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                block = _Block(row, features, len(left_out))
                for m, fold in enumerate(left_out):
                    rows = np.flatnonzero(block.part == fold) if fold is not None else ()
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), x), pa.int32()) for x in (numbers[m], trees, fold)]
                            + [pa.array(block.label[rows]), pa.array(1 / (1 + np.exp(-block.margin[m, rows])))],
                            names=["model", "trees", "fold", "label", "probability"])

    return cut_lineage(blocks.mapInArrow(run, "model int, trees int, fold int, label double, probability double"), "held-out")


def fit(train: DataFrame, features: list[str], specs: list[BoostSpec], label: str = "label", weight: str | None = None,
        part: str | None = None, keys: list[str] | None = None, bins: int = 64, local_rows: int | None = None,
        stages: list[int] | None = None) -> tuple[list[BoostedModel], DataFrame | None]:
    """(models, held-out scores): one model for each spec, over the rows of ``train`` with a label.

    Rows that share their ``keys`` (default: all features) are sampled together.  ``part`` names the fold
    column that ``leave_out`` means; rows without a fold train only models that leave none out.  With
    ``stages`` (numbers of trees) the scores of the rows that models leave out come back as a table
    (model, trees, fold, label, probability), else None.  Without a row of both classes a model
    predicts its class and has no trees."""
    if bins > 250:
        raise ValueError("at most 250 bins")
    spark, local_rows = train.sparkSession, LOCAL_ROWS if local_rows is None else local_rows
    ship_package(spark)
    rows = train.filter(F.col(label).isNotNull()).select(
        *[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_label"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_weight"),
        (F.coalesce(F.col(part).cast("int"), F.lit(-1)) if part else F.lit(0)).alias("_part"),
        F.xxhash64(*(keys or features)).alias("_uid"))
    edges = bin_edges(rows, features, bins)
    folds = {r["_part"]: r for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.sum("_weight").alias("w"),
                                                              F.sum(F.col("_weight") * F.col("_label")).alias("y")).collect()}
    models, rows_of = [], []
    for spec in specs:
        own = [r for p, r in folds.items() if spec.leave_out is None or (p >= 0 and p != spec.leave_out)]
        w, y = sum(r["w"] for r in own), sum(r["y"] for r in own)
        base = float(np.log(y / (w - y))) if 0 < y < w else (50.0 if y else -50.0)
        models.append(BoostedModel(spec, list(features), edges, base))
        rows_of.append(sum(r["n"] for r in own) if 0 < y < w else 0)
    width = max((len(e) for e in edges), default=0) + 2
    # models without trees have scores, too: that of their one class
    small = [m for m, n in enumerate(rows_of) if n <= local_rows]
    large = [m for m, n in enumerate(rows_of) if n > local_rows]
    lockstep = [models[m] for m in large]
    packed = cut_lineage(rows.mapInArrow(_pack(features, edges, "_label", lockstep), BLOCKS), "packed")
    # blocks of one file are dealt out, so that a small table does not make one task of every job
    blocks = cut_lineage(packed.repartition(spark.sparkContext.defaultParallelism, "block"), "blocks") if packed.rdd.getNumPartitions() == 1 else packed
    held: list[DataFrame] = []
    boosted = [m for m in small if rows_of[m] and specs[m].trees]
    if boosted:
        _small_models(blocks, models, boosted, width)
    if stages and any(specs[m].leave_out is not None for m in small):
        held.append(_small_held_out(blocks, models, small, list(stages)))
    latest: dict[int, list[Tree]] = {m: [] for m in range(len(large))}
    for tree in range(max((m.spec.trees for m in lockstep), default=0)):
        active = [i for i, m in enumerate(lockstep) if tree < m.spec.trees]
        for m, t in _next_trees(blocks, lockstep, active, latest, tree, width, [rows_of[m] for m in large], local_rows).items():
            lockstep[m].trees.append(t)
            latest[m].append(t)
        if (tree + 1) % REBASE == 0 or tree + 1 in (stages or ()):
            renewed = _rebased(blocks, lockstep, latest)
            drop_table(spark, blocks)
            blocks, latest = renewed, {m: [] for m in latest}
            if tree + 1 in (stages or ()):
                held.append(_held_out(blocks, lockstep, large, tree + 1))
    drop_table(spark, blocks)
    return models, reduce(DataFrame.unionByName, held) if held else None


def probability(df: DataFrame, model: BoostedModel, out: str = "probability") -> DataFrame:
    """``df`` with the probability of class 1."""
    ship_package(df.sparkSession)
    cols = [c for c in df.columns if c != out]
    names = [f"_x{i}" for i in range(len(model.features))]
    src = df.select(*cols, *[F.col(f).cast("double").alias(n) for f, n in zip(model.features, names)])
    out_type = T.StructType([*df.select(*cols).schema.fields, T.StructField(out, T.DoubleType())])
    edges, base, rate, trees = model.edges, model.base, model.spec.rate, model.trees

    def run(batches):
        for b in batches:
            codes = codes_of(b, names, edges)
            margin = np.full(b.num_rows, base)
            for t in trees:
                margin += rate * t.value[t.leaves(codes)]
            yield pa.RecordBatch.from_arrays([*[b.column(j) for j in range(len(cols))], pa.array(1 / (1 + np.exp(-margin)))], names=[*cols, out])

    return src.mapInArrow(run, out_type)


# ---------------------------------------------------------------- saved models

def save(spark: SparkSession, model: BoostedModel, path: str) -> None:
    """Write the model as two Parquet tables below ``path``: ``about`` (one JSON row) and ``nodes``."""
    about = json.dumps({"spec": asdict(model.spec), "features": model.features, "edges": model.edges, "base": model.base, "trees": len(model.trees)})
    spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(f"{path}/about")
    nodes = [(i, j, *[x.item() for x in row]) for i, t in enumerate(model.trees)
             for j, row in enumerate(zip(t.feature, t.cut, t.left, t.right, t.value, t.gain))]
    kind = "tree int, node int, feature long, cut long, `left` long, `right` long, value double, gain double"
    spark.createDataFrame(nodes, kind).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")


def load(spark: SparkSession, path: str) -> BoostedModel:
    about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
    model = BoostedModel(BoostSpec(**about["spec"]), about["features"], about["edges"], about["base"])
    rows = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
    by_tree: list[list] = [[] for _ in range(about["trees"])]
    for r in rows:
        by_tree[r["tree"]].append(r[2:])
    for nodes in by_tree:
        cols = list(zip(*nodes))
        model.trees.append(Tree(*[np.array(c, dtype=np.int64) for c in cols[:4]], *[np.array(c) for c in cols[4:]]))
    return model
