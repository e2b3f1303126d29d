"""Gradient-boosted trees with Poisson loss, many fits over one pass of the rows.

Spark ML's trees know squared and absolute loss only. Here trees are grown from
second-order Poisson gradients: with margin F a row has the gradient exp(F) - y
and the hessian exp(F + 0.7). Features are binned once; bin 0 is "missing", which
is also where unseen categories go, and every split sends bin 0 one way.

The binned rows are stored as columnar blocks. A pass over the blocks adds, in
every task, the gradients of all open nodes per (node, feature, bin); Spark sums
the tasks' tables, and the driver picks the splits. Fits that differ in
parameters, features or training months share their passes: a sweep over
candidates and windows takes as many passes as one of its fits. Sums are of whole
numbers (gradients in fixed point), so results do not depend on the order in
which tasks finish.

A pass costs a job however few rows there are, and a fit of 2,000 trees takes
14,000. Up to ``LOCAL_CELLS`` binned values the blocks are therefore sent to the
executors, and every fit is grown in a task of its own by the same sums and
splits: the trees are the same ones. Beyond that bound nothing that grows with
the rows reaches the driver or a single task.

Trees grow level by level; where more leaves could be split than ``num_leaves``
allows, those with the largest gain are. Of two sibling nodes only the smaller
one is summed, the other is the rest of their parent.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.exprs import discard, materialize, prefix_sums

MAX_BINS = 64            # of a numeric feature, besides the one of missing values
MAX_LEVELS = 60_000      # of a categorical feature; bins are 16-bit numbers
BLOCK_ROWS = 4096
REWRITE_TREES = 4        # trees after which the rows' margins are stored anew
MAX_FITS = 64            # fits that share a pass
LOCAL_CELLS = 1 << 25    # binned values (rows x features, 64 MB) up to which a task grows a whole fit
BUNDLE = 1 << 12         # combinations of bins up to which features are counted together
SPLIT_CELLS = 1 << 18    # bins whose splits are searched at once
HESSIAN_SHIFT = 0.7      # fixed value: the published step safeguard of Poisson boosting
MIN_HESSIAN = 1e-3
CATEGORY_SMOOTH, CATEGORY_L2 = 10.0, 10.0
DEFAULTS = {"n_estimators": 100, "learning_rate": 0.1, "num_leaves": 31, "min_child_samples": 20, "max_depth": 8,
            "l2": 0.0, "early_stopping": 50}


# ---------------------------------------------------------------- binning
@dataclass
class Bins:
    """How raw values become bins: ascending upper bounds of a numeric feature,
    the levels of a categorical one."""

    features: list[str]
    edges: dict[str, list[float]]
    levels: dict[str, list[str]]

    def sizes(self) -> list[int]:
        """Bins of every feature, the missing one included."""
        return [(len(self.levels[f]) if f in self.levels else len(self.edges[f]) + 1) + 1 for f in self.features]

    def of(self, columns: list[pa.Array]) -> np.ndarray:
        """(features, rows) of bins."""
        out = np.zeros((len(columns), len(columns[0]) if columns else 0), np.uint16)
        for i, (f, c) in enumerate(zip(self.features, columns)):
            if f in self.levels:
                at = {v: k + 1 for k, v in enumerate(self.levels[f])}
                out[i] = [at.get(v, 0) for v in c.to_pylist()]
            else:
                x = c.to_numpy(zero_copy_only=False).astype(np.float64)
                out[i] = np.where(np.isnan(x), 0, np.searchsorted(np.array(self.edges[f]), x, side="left") + 1)
        return out


def _raw(frame: DataFrame, bins_or_features) -> list:
    """Feature columns as the binning reads them: numbers as doubles, categories as strings."""
    kinds = dict(frame.dtypes)
    return [F.col(f).cast("string" if kinds[f] == "string" else "double").alias(f"_f{i}") for i, f in enumerate(bins_or_features)]


def make_bins(rows: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> Bins:
    """Bins from the given (training) rows. Numeric values are counted per
    distinct value; a feature with at most ``max_bins`` of them keeps them all,
    others get bounds at equal shares of the rows, from distributed prefix sums.
    At most ``max_bins`` bounds or ``MAX_LEVELS`` levels a feature reach the driver."""
    kinds = dict(rows.dtypes)
    cats = [f for f in features if kinds[f] == "string"]
    nums = [f for f in features if f not in cats]
    levels = {}
    for f in cats:
        got = [r[0] for r in rows.select(F.col(f).alias("v")).filter("v IS NOT NULL").distinct().orderBy("v").limit(MAX_LEVELS + 1).collect()]
        if len(got) > MAX_LEVELS:
            raise ValueError(f"{f} has more than {MAX_LEVELS} levels")
        levels[f] = got
    edges: dict[str, list[float]] = {f: [] for f in nums}
    if nums:
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in nums]))
        counts = (rows.select(pairs.alias("p")).select("p.*").filter("value IS NOT NULL AND NOT isnan(value)")
                  .groupBy("feature", "value").agg(F.count("*").alias("n")))
        ranked = prefix_sums(counts, ["feature"], "value", ["n"])
        kinds_of = ranked.groupBy("feature").agg(F.count("*").alias("_distinct"))
        share = F.ceil(F.col("n_upto") * max_bins / F.col("n_total"))
        group = F.when(F.col("_distinct") <= max_bins, F.col("value")).otherwise(share.cast("double"))
        bounds = (ranked.join(kinds_of, "feature").groupBy("feature", group.alias("_g")).agg(F.max("value").alias("bound"))
                  .select("feature", "bound").orderBy("feature", "bound").collect())
        for r in bounds:
            edges[r["feature"]].append(r["bound"])
    return Bins(list(features), {f: e[:-1] for f, e in edges.items()}, levels)


# ---------------------------------------------------------------- trees
@dataclass
class Tree:
    """Nodes in arrays; ``left`` < 0 marks a leaf. ``goes_left[i]`` lists the bins
    that node i sends left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    goes_left: list[list[int]] = field(default_factory=lambda: [[]])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    missing_left: list[bool] = field(default_factory=lambda: [False])

    def split(self, node: int, feature: int, goes_left: list[int], gain: float) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.goes_left[node], self.gain[node] = feature, goes_left, gain
        self.left[node], self.right[node], self.missing_left[node] = a, a + 1, 0 in goes_left
        for _ in range(2):
            self.feature.append(-1)
            self.left.append(-1)
            self.right.append(-1)
            self.goes_left.append([])
            self.value.append(0.0)
            self.gain.append(0.0)
            self.missing_left.append(False)
        return a, a + 1

    def packed(self, widest: int) -> tuple:
        """Arrays for ``leaf_of``: feature, left, right, (node, bin) -> goes left, value."""
        table = np.zeros((len(self.feature), widest), bool)
        for i, bins in enumerate(self.goes_left):
            table[i, bins] = True
        return (np.array(self.feature), np.array(self.left), np.array(self.right), table, np.array(self.value))


class Trees(Sequence):
    """Trees as compressed JSON, read whenever they are used: as objects those of a sweep would take hundreds of MB."""

    def __init__(self, packed: bytes, n: int):
        self.packed, self.n = packed, n

    @staticmethod
    def of(trees: list[Tree]) -> Trees:
        return Trees(zlib.compress(json.dumps([vars(t) for t in trees]).encode()), len(trees))

    def text(self) -> str:
        return zlib.decompress(self.packed).decode()

    def __len__(self) -> int:
        return self.n

    def __iter__(self):
        return iter([Tree(**t) for t in json.loads(self.text())])

    def __getitem__(self, i):
        return list(self)[i]


def leaf_of(packed: tuple, bins: np.ndarray) -> np.ndarray:
    """The leaf of every row of (features, rows) bins; all rows step down together."""
    feature, left, right, table, _ = packed
    node = np.zeros(bins.shape[1], np.int64)
    at = np.arange(bins.shape[1])
    while len(at):
        n = node[at]
        open_ = left[n] >= 0
        at, n = at[open_], n[open_]
        if len(at):
            b = bins[feature[n], at]
            node[at] = np.where(table[n, b], left[n], right[n])
    return node


@dataclass
class PoissonModel:
    """A fitted model: bins, start margin and trees."""

    bins: Bins
    base: float
    trees: Sequence[Tree]
    val_mae: float = math.nan

    def to_json(self) -> str:
        head = json.dumps({"features": self.bins.features, "edges": self.bins.edges, "levels": self.bins.levels, "base": self.base, "val_mae": self.val_mae})
        trees = self.trees.text() if isinstance(self.trees, Trees) else json.dumps([vars(t) for t in self.trees])
        return f'{head[:-1]}, "trees": {trees}}}'

    @staticmethod
    def from_json(text: str) -> PoissonModel:
        d = json.loads(text)
        return PoissonModel(Bins(d["features"], d["edges"], d["levels"]), d["base"], [Tree(**t) for t in d["trees"]], d["val_mae"])

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(bins.shape[1], self.base)
        widest = max(self.bins.sizes(), default=1)
        for t in self.trees:
            p = t.packed(widest)
            out += p[4][leaf_of(p, bins)]
        return out

    def score(self, frame: DataFrame, out: str = "prediction") -> DataFrame:
        """Adds the expected count of every row: positive, never null; a column
        named like ``out`` is replaced."""
        keep = [c for c in frame.columns if c != out]
        src = frame.select(*keep, *_raw(frame, self.bins.features))
        model = frame.sparkSession.sparkContext.broadcast(zlib.compress(self.to_json().encode()))  # bounded by trees, leaves and levels

        def run(batches):
            m = PoissonModel.from_json(zlib.decompress(model.value).decode())
            for b in batches:
                mu = np.exp(m.margins(m.bins.of(b.columns[len(keep):])))
                yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(mu)], [*keep, out])

        return src.mapInArrow(run, StructType([*src.schema.fields[:len(keep)], StructField(out, DoubleType())]))

    def gains(self) -> dict[str, float]:
        """Total gain of the splits on each feature."""
        total = dict.fromkeys(self.bins.features, 0.0)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[self.bins.features[f]] += g
        return total


# ---------------------------------------------------------------- splits
@dataclass(frozen=True)
class Layout:
    """Where each feature's bins lie in a node's flat table."""

    sizes: tuple[int, ...]
    categorical: tuple[bool, ...]

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)


@dataclass
class Split:
    gain: float
    feature: int
    goes_left: list[int]
    rows_left: int


def best_splits(tables: np.ndarray, layout: Layout, usable: list[int], params: dict) -> list[Split | None]:
    """Per node the split of largest gain, given (node, bin, [gradient, hessian,
    rows]) tables; None where none is allowed or gains anything. Ties go to the
    earlier feature, then missing right, then the fewest bins left.

    A numeric feature is cut between two bins. The levels of a categorical one
    are ordered by gradient over hessian and cut there. Missing rows are tried
    on both sides; where there are none, they would go with the larger side.
    """
    off, l2, least = layout.offsets, params["l2"], params["min_child_samples"]
    shape = (len(tables), len(usable))
    gains, cuts, sides, orders = np.full(shape, -np.inf), np.zeros(shape, int), np.zeros(shape, bool), {}
    flat = np.zeros((3, len(tables), int(off[-1]) + 1))  # the last bin stays empty
    flat[:, :, :-1] = tables.transpose(2, 0, 1)
    cats = [j for j, f in enumerate(usable) if layout.categorical[f]]
    for group in ([j for j in range(len(usable)) if j not in cats], *([j] for j in cats)):  # numeric ones together
        first, sizes = (np.array([x[usable[j]] for j in group], int) for x in (off, layout.sizes))
        at = np.arange(max(sizes - 1, default=0))
        if not len(at):
            continue
        cat = group[0] in cats
        reg = l2 + (CATEGORY_L2 if cat else 0.0)
        ends = sizes[:, None] - 1
        cells = flat.take(np.where(at < ends, first[:, None] + 1 + at, off[-1]), axis=2)  # (3, nodes, features, bins)
        missing = flat.take(first, axis=2)[..., None]
        some = missing[2] > 0
        if cat:
            order = np.argsort(np.where(cells[2] > 0, cells[0] / (cells[1] + CATEGORY_SMOOTH), np.inf), axis=-1, kind="stable")
            cells, ends, orders[group[0]] = np.take_along_axis(cells, order[None], -1), (cells[2] > 0).sum(-1, keepdims=True), order[:, 0]
        low = np.cumsum(cells, axis=-1)
        g, h, n = low[..., -1:] + missing
        allowed = at < ends - ~some
        for with_missing in ((False, True) if some.any() else (False,)):
            gl, hl, nl = low + missing if with_missing else low
            ok = allowed & (nl >= least) & (n - nl >= least) & (hl >= MIN_HESSIAN) & (h - hl >= MIN_HESSIAN)
            if with_missing:
                ok &= some
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, gl ** 2 / (hl + reg) + (g - gl) ** 2 / (h - hl + reg) - g ** 2 / (h + reg), -np.inf)
            cut = gain.argmax(-1)
            top = np.take_along_axis(gain, cut[..., None], -1)[..., 0]
            better = top > gains[:, group]
            for kept, new in ((gains, top), (cuts, cut), (sides, with_missing)):
                kept[:, group] = np.where(better, new, kept[:, group])
    best: list[Split | None] = []
    for i, j in enumerate(gains.argmax(1)):
        if not gains[i, j] > 1e-9:
            best.append(None)
            continue
        f, k = usable[j], int(cuts[i, j]) + 1
        left = sorted((orders[j][i, :k] + 1).tolist()) if j in orders else list(range(1, k + 1))
        rows = tables[i, off[f]:off[f + 1], 2]
        n_left = rows[left].sum() + (rows[0] if sides[i, j] else 0)
        goes = sides[i, j] if rows[0] else n_left > rows.sum() - n_left
        best.append(Split(float(gains[i, j]), f, ([0] if goes else []) + left, int(n_left)))
    return best


# ---------------------------------------------------------------- fitting
@dataclass(frozen=True)
class FitSpec:
    """One fit: rows before ``fit_before`` train it, rows from there to before
    ``valid_before`` choose the number of trees (None: all trees are kept)."""

    name: str
    features: tuple[str, ...]
    params: dict
    fit_before: dt.datetime
    valid_before: dt.datetime | None = None

    def param(self) -> dict:
        return DEFAULTS | self.params


def _micros(t: dt.datetime) -> int:
    return int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))


def _blocks(rows: DataFrame, bins: Bins, time: str, label: str, bases: list[float]) -> DataFrame:
    """Columnar blocks of (label, time, bins, margins) with at most ``BLOCK_ROWS`` rows."""
    src = rows.select(F.col(label).cast("double").alias("_y"), F.unix_micros(F.col(time).cast("timestamp")).alias("_t"), *_raw(rows, bins.features))
    start = np.array(bases)

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, BLOCK_ROWS):
                c = b.slice(i, BLOCK_ROWS).columns
                n = len(c[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int64()), pa.array([c[0].to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
                     pa.array([c[1].to_numpy(zero_copy_only=False).astype(np.int64).tobytes()], pa.binary()), pa.array([bins.of(c[2:]).tobytes()], pa.binary()),
                     pa.array([np.repeat(start[:, None], n, 1).tobytes()], pa.binary())], ["n", "y", "t", "bins", "margins"])

    return materialize(src.mapInArrow(run, "n long, y binary, t binary, bins binary, margins binary"), "table")


class _Fit:
    """A fit in progress: its finished trees, and the tree that is growing."""

    def __init__(self, spec: FitSpec, base: float, layout: Layout, features: list[str]):
        self.spec, self.p, self.base, self.layout, self.features = spec, spec.param(), base, layout, features
        self.usable = [i for i, f in enumerate(features) if f in set(spec.features)]
        self.trees: list[Tree] = []
        self.maes: list[float] = []
        self.done = False
        self.begin()

    def begin(self) -> None:
        self.tree, self.tables, self.sums = Tree(), {}, {}
        self.sum_nodes, self.rest = [0], {}
        self.leaves, self.depth, self.grown = 1, 0, False

    def end_tree(self) -> None:
        self.trees.append(self.tree)
        self.done = self.tree.left[0] < 0 or len(self.trees) >= self.p["n_estimators"] and self.spec.valid_before is None
        self.begin()

    def kept(self) -> tuple[list[Tree], float]:
        """The trees up to the least validation error, in terms of the fit's own features, and that error; all trees without validation rows."""
        k = min(range(len(self.maes)), key=self.maes.__getitem__) if self.maes else len(self.trees)
        return [_renumbered(t, self.features, self.spec.features) for t in self.trees[:k]], self.maes[k] if self.maes else math.nan

    def take(self, found: np.ndarray) -> None:
        """Splits nodes, given the tables of ``sum_nodes``; the tree is grown when nothing may be split any more."""
        level = dict(zip(self.sum_nodes, found))
        for node, (parent, sibling) in self.rest.items():
            level[sibling] = self.tables[parent] - level[node]
        if self.depth == 0:
            f = self.usable[0]
            self.sums[0] = found[0][self.layout.offsets[f]:self.layout.offsets[f + 1]].sum(0)
        self.tables = level
        nodes, step = list(level), max(1, SPLIT_CELLS // int(self.layout.offsets[-1]))
        splits = [(s.gain, node, s) for i in range(0, len(nodes), step)
                  for node, s in zip(nodes[i:], best_splits(np.stack([level[x] for x in nodes[i:i + step]]), self.layout, self.usable, self.p)) if s]
        splits = sorted(splits, key=lambda x: (-x[0], x[1]))[:self.p["num_leaves"] - self.leaves]
        self.sum_nodes, self.rest = [], {}
        for _, node, s in sorted(splits, key=lambda x: x[1]):
            a, b = self.tree.split(node, s.feature, s.goes_left, s.gain)
            self.sums[a] = level[node][self.layout.offsets[s.feature] + np.array(s.goes_left)].sum(0)
            self.sums[b] = self.sums[node] - self.sums[a]
            small, large = (a, b) if self.sums[a][2] <= self.sums[b][2] else (b, a)
            self.sum_nodes.append(small)
            self.rest[small] = (node, large)
            self.leaves += 1
        self.depth += 1
        if not self.sum_nodes or self.leaves >= self.p["num_leaves"] or self.depth >= self.p["max_depth"]:
            for node, left in enumerate(self.tree.left):
                if left < 0:
                    g, h, _ = self.sums[node]
                    self.tree.value[node] = float(-self.p["learning_rate"] * g / (h + self.p["l2"])) if h > 0 else 0.0
            self.grown = True


def fit_many(rows: DataFrame, specs: list[FitSpec], time: str = "hour", label: str = "trips", max_bins: int = MAX_BINS) -> list[PoissonModel]:
    """The models of all ``specs``, in order. ``rows`` holds every feature that a
    spec names; a null label is an error of the caller's filter. A fit without
    training rows raises."""
    out: list[PoissonModel] = []
    for i in range(0, len(specs), MAX_FITS):
        out += _fit_group(rows, specs[i:i + MAX_FITS], time, label, max_bins)
    return out


def _fit_group(rows: DataFrame, specs: list[FitSpec], time: str, label: str, max_bins: int) -> list[PoissonModel]:
    features = list(dict.fromkeys(f for s in specs for f in s.features))
    ends = [max(s.fit_before, s.valid_before or s.fit_before) for s in specs]
    used = rows.where(F.col(time) < F.lit(max(ends))).select(time, label, *features)
    # bounds come from rows that train every fit; levels from all that train any (unseen ones have no rows in a fit's tables)
    numeric = make_bins(used.where(F.col(time) < F.lit(min(s.fit_before for s in specs))), [f for f, k in used.dtypes if f in features and k != "string"], max_bins)
    levels = make_bins(used.where(F.col(time) < F.lit(max(s.fit_before for s in specs))), [f for f, k in used.dtypes if f in features and k == "string"], max_bins)
    bins = Bins(features, numeric.edges, levels.levels)
    layout = Layout(tuple(bins.sizes()), tuple(f in bins.levels for f in features))

    each = [F.struct(F.sum(F.when(F.col(time) < F.lit(s.fit_before), F.col(label).cast("decimal(20,0)"))).alias("y"),
                     F.count_if(F.col(time) < F.lit(s.fit_before)).alias("n"),
                     F.count_if((F.col(time) >= F.lit(s.fit_before)) & (F.col(time) < F.lit(s.valid_before or s.fit_before))).alias("held")).alias(f"s{i}") for i, s in enumerate(specs)]
    start = used.agg(*each, F.max(F.col(label).cast("double")).alias("largest"), F.count(F.lit(1)).alias("rows")).first()
    if any(not start[f"s{i}"]["n"] for i in range(len(specs))):
        raise ValueError("a fit has no training rows")
    if any(s.valid_before and not start[f"s{i}"]["held"] for i, s in enumerate(specs)):
        raise ValueError("a fit has no validation rows")
    bases = [math.log(max(float(start[f"s{i}"]["y"]) / start[f"s{i}"]["n"], 1e-6)) for i in range(len(specs))]
    n_rows = max(start[f"s{i}"]["n"] for i in range(len(specs)))
    # gradients in fixed point: sums over all rows stay below 2^62
    bits = max(4, min(26, 60 - int(n_rows).bit_length() - int(max(start["largest"], 1.0) * 8).bit_length()))
    fits = [_Fit(s, b, layout, features) for s, b in zip(specs, bases)]
    if start["rows"] * len(features) <= LOCAL_CELLS:
        grown = _grow_local(_blocks(used, bins, time, label, []), fits, layout, len(features), bits)
    else:
        _grow_in_passes(_blocks(used, bins, time, label, bases), fits, layout, len(features), bits)
        grown = [f.kept() for f in fits]
    return [PoissonModel(_own_bins(bins, f.spec.features), f.base, trees, mae) for f, (trees, mae) in zip(fits, grown)]


def _grow_in_passes(state: DataFrame, fits: list[_Fit], layout: Layout, n_features: int, bits: int) -> None:
    """Grows all fits together, a pass over the blocks for every level."""
    pending: list[list[Tree]] = [[] for _ in fits]  # trees that the stored margins do not hold yet
    while not all(f.done for f in fits):
        for f in fits:
            f.grown = f.done
        first = True
        while not all(f.grown for f in fits):
            got = _pass(state, fits, pending, layout, n_features, bits, first)
            if first:
                _stop_early(fits, [g[1] for g in got])
            for f, (tables, _) in zip(fits, got):
                f.grown |= f.done
                if not f.grown:
                    f.take(tables)
            first = False
        for f, p in zip(fits, pending):
            if not f.done:
                p.append(f.tree)
                f.end_tree()
        if not all(f.done for f in fits) and max(map(len, pending)) >= REWRITE_TREES:
            before, state = state, _with_margins(state, pending, layout, n_features)
            discard(before)
            pending = [[] for _ in fits]
    discard(state)


class _Rows:
    """The training rows of one fit, and their sums per bin.

    Features whose bins take at most ``BUNDLE`` combinations in these rows are
    counted as one: a large node is summed per combination, and every feature's
    bins are sums of those. A node of few rows is summed bin by bin.
    """

    def __init__(self, bins: np.ndarray, usable: list[int], layout: Layout):
        self.size, off = int(layout.offsets[-1]), layout.offsets
        self.cells = np.empty((bins.shape[1], len(usable)), np.uint16 if self.size <= 1 << 16 else np.int32)
        bundles: list[tuple[np.ndarray, dict[int, np.ndarray]]] = []  # code of every row, feature -> bin of every code
        for k, f in enumerate(usable):
            self.cells[:, k] = bins[f] + off[f]
            for i, (code, members) in enumerate(bundles):
                codes = len(next(iter(members.values())))
                if codes * layout.sizes[f] > BUNDLE << 10:
                    continue
                joint = code * layout.sizes[f] + bins[f]
                seen = np.bincount(joint, minlength=codes * layout.sizes[f]) > 0
                if seen.sum() <= BUNDLE:
                    both = np.flatnonzero(seen)
                    bundles[i] = ((np.cumsum(seen) - 1)[joint], {g: m[both // layout.sizes[f]] for g, m in members.items()} | {f: both % layout.sizes[f]})
                    break
            else:
                bundles.append((bins[f].astype(np.intp), {f: np.arange(layout.sizes[f])}))
        self.bundles, self.small = [], 0
        for code, members in bundles:
            codes, ways = len(next(iter(members.values()))), []
            for f, m in members.items():
                order = np.argsort(m, kind="stable")
                found, starts = np.unique(m[order], return_index=True)
                ways.append((order, starts, found + off[f]))
            self.bundles.append((code.astype(np.min_scalar_type(codes)), codes, ways))
            self.small += codes * len(members)
        self.small //= len(usable)

    def sums(self, at: np.ndarray, weights: list[np.ndarray], chunk: int) -> np.ndarray:
        """(bin, [gradient, hessian, rows]) whole numbers of the rows ``at``;
        ``chunk`` rows of the weights are added exactly."""
        out = np.zeros((3, self.size), np.int64)
        chunk = min(chunk, 8 * BLOCK_ROWS)
        if len(at) <= self.small:
            for i in range(0, len(at), chunk):
                part = at[i:i + chunk]
                cell = self.cells[part].ravel().astype(np.intp)
                for k, w in enumerate(weights):
                    out[k] += np.bincount(cell, np.repeat(w[part], self.cells.shape[1]), self.size).astype(np.int64)
                out[2] += np.bincount(cell, minlength=self.size)
            return out.T
        found = [np.zeros((3, codes), np.int64) for _, codes, _ in self.bundles]
        for i in range(0, len(at), chunk):
            part = at[i:i + chunk] if len(at) < len(self.cells) else slice(i, i + chunk)
            some = [w[part] for w in weights]
            for (code, codes, _), x in zip(self.bundles, found):
                c = code[part].astype(np.intp)
                for k, w in enumerate(some):
                    x[k] += np.bincount(c, w, codes).astype(np.int64)
                x[2] += np.bincount(c, minlength=codes)
        for (_, _, ways), x in zip(self.bundles, found):
            for order, starts, cells in ways:
                out[:, cells] = np.add.reduceat(x.take(order, axis=1), starts, axis=1)
        return out.T


def _grow_alone(fit: _Fit, blocks: list[tuple], layout: Layout, n_features: int, bits: int) -> None:
    """Grows one fit from all of its rows, by the sums and splits of the passes."""
    unit, before = float(1 << bits), _micros(fit.spec.fit_before)
    until = _micros(fit.spec.valid_before) if fit.spec.valid_before else before
    parts: list[list[tuple]] = [[], []]
    for n, y, t, bins in blocks:
        t = np.frombuffer(t, np.int64)
        for part, some in zip(parts, (t < before, (t >= before) & (t < until))):
            if some.any():
                part.append((np.frombuffer(y)[some], np.frombuffer(bins, np.uint16).reshape(n_features, n)[:, some]))
    none = (np.zeros(0), np.zeros((n_features, 0), np.uint16))
    (y, bins), (held_y, held) = ((np.concatenate([x[0] for x in p or [none]]), np.concatenate([x[1] for x in p or [none]], axis=1)) for p in parts)
    # no node can be cut by a feature whose training rows share a bin
    fit.usable = [f for f in fit.usable if bins[f].min() != bins[f].max()] or fit.usable[:1]
    rows, widest = _Rows(bins, fit.usable, layout), max(layout.sizes)
    margin, held_margin = np.full(len(y), fit.base), np.full(len(held_y), fit.base)
    while not fit.done:
        if fit.spec.valid_before is not None:
            error = np.rint(np.abs(np.exp(held_margin) - held_y) * unit).sum()
            _stop_early([fit], [int(error) / unit / len(held_y) if len(held_y) else None])
            if fit.done:
                break
        mu = np.exp(margin)
        weights = [(mu - y) * unit, mu * math.exp(HESSIAN_SHIFT) * unit]
        for w in weights:
            np.rint(w, out=w)
        chunk = max(1, int(2 ** 51 / (max(mu.max(), y.max()) * 2 * unit + 1)))
        at = {0: np.arange(len(y))}
        while not fit.grown:
            fit.take(np.stack([rows.sums(at[node], weights, chunk) for node in fit.sum_nodes]) / np.array([unit, unit, 1.0]))
            for node in [x for x in at if fit.tree.left[x] >= 0]:
                own, goes = at.pop(node), np.zeros(widest, bool)
                goes[fit.tree.goes_left[node]] = True
                bin_of = bins[fit.tree.feature[node]]
                left = goes[(bin_of if len(own) == len(y) else bin_of[own]).astype(np.intp)]
                at[fit.tree.left[node]], at[fit.tree.right[node]] = own.compress(left), own.compress(~left)
        for node, own in at.items():
            margin[own] += fit.tree.value[node]
        packed = fit.tree.packed(widest)
        held_margin += packed[4][leaf_of(packed, held)]
        fit.end_tree()


def _grow_local(blocks: DataFrame, fits: list[_Fit], layout: Layout, n_features: int, bits: int) -> list[tuple[Trees, float]]:
    """What every fit keeps, grown in a task of its own, which has all blocks: at
    most ``LOCAL_CELLS`` bins are sent to the driver and from there to the executors."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast([tuple(r) for r in blocks.select("n", "y", "t", "bins").collect()])
    # fits of small steps take the most trees: they begin first
    turn = sorted(range(len(fits)), key=lambda i: (fits[i].p["learning_rate"], -fits[i].p["num_leaves"]))

    def run(batches):
        for b in batches:
            for k in b.column(0).to_pylist():
                _grow_alone(fit := fits[turn[k]], shared.value, layout, n_features, bits)
                trees, mae = fit.kept()
                trees = Trees.of(trees)
                yield pa.RecordBatch.from_arrays([pa.array([turn[k]], pa.int32()), pa.array([trees.packed], pa.binary()), pa.array([trees.n], pa.int32()), pa.array([mae])], ["fit", "trees", "n", "mae"])

    rows = spark.range(0, len(fits), 1, len(fits)).mapInArrow(run, "fit int, trees binary, n int, mae double").collect()
    shared.destroy()
    discard(blocks)
    return [(Trees(bytes(r["trees"]), r["n"]), r["mae"]) for r in sorted(rows, key=lambda r: r["fit"])]


def _own_bins(bins: Bins, features: tuple[str, ...]) -> Bins:
    return Bins(list(features), {f: bins.edges[f] for f in features if f in bins.edges}, {f: bins.levels[f] for f in features if f in bins.levels})


def _renumbered(t: Tree, features: list[str], own: tuple[str, ...]) -> Tree:
    at = {f: i for i, f in enumerate(own)}
    return Tree([at[features[f]] if f >= 0 else -1 for f in t.feature], t.left, t.right, t.goes_left, t.value, t.gain, t.missing_left)


def _stop_early(fits: list[_Fit], errors: list[float | None]) -> None:
    """``errors``: mean absolute error on the validation rows of the trees so far."""
    for f, e in zip(fits, errors):
        if f.done or f.spec.valid_before is None:
            continue
        if e is None:
            raise ValueError("a fit has no validation rows")
        f.maes.append(e)
        best = min(range(len(f.maes)), key=f.maes.__getitem__)
        f.done = len(f.trees) >= f.p["n_estimators"] or len(f.maes) - 1 - best >= f.p["early_stopping"]


def _pass(state: DataFrame, fits: list[_Fit], pending: list[list[Tree]], layout: Layout, n_features: int, bits: int, first: bool):
    """One pass: for every fit the tables of its ``sum_nodes`` and, on a tree's
    first pass, the validation error of the trees before it."""
    widest, cells, offsets = max(layout.sizes), int(layout.offsets[-1]), layout.offsets[:-1]
    unit = float(1 << bits)
    work = [(i, [t.packed(widest) for t in pending[i]], f.tree.packed(widest), list(f.sum_nodes), _micros(f.spec.fit_before),
             _micros(f.spec.valid_before) if f.spec.valid_before else None) for i, f in enumerate(fits) if not f.grown]

    def run(batches):
        tables = {i: np.zeros((3, len(nodes) * cells), np.int64) for i, _, _, nodes, _, _ in work}
        errors = {i: [0, 0] for i, *_ in work}
        for b in batches:
            for n, y, t, bins, margins in zip(*(c.to_pylist() for c in b.columns)):
                y, t = np.frombuffer(y), np.frombuffer(t, np.int64)
                bins, margins = np.frombuffer(bins, np.uint16).reshape(n_features, n), np.frombuffer(margins).reshape(-1, n)
                cell_of = offsets[:, None] + bins  # the same for all fits
                for i, trees, growing, nodes, fit_before, valid_before in work:
                    margin = margins[i]
                    for p in trees:
                        margin = margin + p[4][leaf_of(p, bins)]
                    if first and valid_before is not None:
                        held = (t >= fit_before) & (t < valid_before)
                        errors[i][0] += int(np.rint(np.abs(np.exp(margin[held]) - y[held]) * unit).sum())
                        errors[i][1] += int(held.sum())
                    if not nodes:
                        continue
                    index = np.full(len(growing[0]), -1)
                    index[nodes] = np.arange(len(nodes))
                    at = np.flatnonzero(t < fit_before)
                    slot = index[leaf_of(growing, bins if len(at) == n else bins[:, at])]
                    at, slot = at[slot >= 0], slot[slot >= 0]
                    mu = np.exp(margin[at])
                    cell = ((slot * cells)[None] + (cell_of if len(at) == n else cell_of[:, at])).ravel()
                    size = tables[i].shape[1]
                    for k, w in enumerate([np.rint((mu - y[at]) * unit), np.rint(mu * math.exp(HESSIAN_SHIFT) * unit)]):
                        tables[i][k] += np.bincount(cell, np.tile(w, n_features), size).astype(np.int64)
                    tables[i][2] += np.bincount(cell, minlength=size)
        for i in tables:
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([tables[i].T.tobytes()], pa.binary()),
                                              pa.array([errors[i][0]], pa.int64()), pa.array([errors[i][1]], pa.int64())], ["fit", "sums", "error", "held"])

    def add(batches):
        total: dict[int, list] = {}
        for b in batches:
            for i, sums, error, held in zip(*(c.to_pylist() for c in b.columns)):
                x = np.frombuffer(sums, np.int64)
                if i in total:
                    total[i] = [total[i][0] + x, total[i][1] + error, total[i][2] + held]
                else:
                    total[i] = [x, error, held]
        for i, (x, error, held) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([x.tobytes()], pa.binary()),
                                              pa.array([error], pa.int64()), pa.array([held], pa.int64())], ["fit", "sums", "error", "held"])

    schema = "fit int, sums binary, error long, held long"
    parts = max(1, min(len(work), int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    got = {r["fit"]: r for r in state.mapInArrow(run, schema).repartition(parts, "fit").mapInArrow(add, schema).collect()}
    out = []
    for i, f in enumerate(fits):
        r = got.get(i)
        if r is None:
            out.append((np.zeros((len(f.sum_nodes), cells, 3)), None))
            continue
        sums = np.frombuffer(bytes(r["sums"]), np.int64).reshape(-1, cells, 3) / np.array([unit, unit, 1.0])
        out.append((sums, r["error"] / unit / r["held"] if r["held"] else None))
    return out


def _with_margins(state: DataFrame, pending: list[list[Tree]], layout: Layout, n_features: int) -> DataFrame:
    """The blocks with the pending trees added to their margins, written anew."""
    widest = max(layout.sizes)
    packed = [[t.packed(widest) for t in trees] for trees in pending]

    def run(batches):
        for b in batches:
            new = []
            for n, bins, margins in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
                bins, margins = np.frombuffer(bins, np.uint16).reshape(n_features, n), np.frombuffer(margins).reshape(-1, n).copy()
                for i, trees in enumerate(packed):
                    for p in trees:
                        margins[i] += p[4][leaf_of(p, bins)]
                new.append(margins.tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(new, pa.binary())], ["n", "y", "t", "bins", "margins"])

    return materialize(state.mapInArrow(run, state.schema), "table")


def feature_gains(model: PoissonModel, spark: SparkSession) -> DataFrame:
    """(feature, importance): total split gain, descending; one row per feature."""
    rows = [(f, float(g)) for f, g in model.gains().items()]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
