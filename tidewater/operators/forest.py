"""Random forests for regression whose trees grow in tasks of bounded size.

Spark ML grows all trees level by level and sends every node's statistics through a shuffle; unlimited depth makes about as many nodes as
rows, for every tree. Here rows are binned once (a byte per feature); nodes of more than ``TREE_ROWS`` drawn rows are cut by statistics
summed over all tasks, as Spark ML does, and the rows of each smaller node are then dealt to one task, which grows what lies below it. Up to ``TREE_ROWS`` rows, a tree
is grown in one task as a whole. The settings are those of Spark ML: Poisson draws of rows, a third of the features for each node, 32 bins,
variance. A fit uses all rows, also for the points at which features are cut.

A tree of a lower depth is the beginning of a deeper one, and the trees of a smaller forest are the first of a larger one. ``Forest`` takes several
settings: it grows the largest number of trees to the greatest depth once, and predicts with each setting's part of them, which equals fitting that setting alone.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import TASKS_PER_CORE, cut_lineage, tasks_for
from . import forest_core as core
from .selection import quantiles_of

cloudpickle.register_pickle_by_value(core)  # executors need not have the package

#: Rows that a task grows a tree from, and that it predicts, at most: about 60 MB with its sorts.
TREE_ROWS = 1 << 19
#: Rows times trees that are dealt at once: bounds the disk that a fit needs.
DEALT_ROWS = 1 << 24

_SQL = {"int64": "long", "binary": "binary", "double": "double"}


def _schema(fields: Mapping) -> str:
    return ", ".join(f"{name} {_SQL[str(kind)]}" for name, kind in fields.items())


def split_points(rows: DataFrame, width: int, bins: int = core.BINS) -> list[np.ndarray]:
    """Where each feature of ``rows`` (a list ``x``) is cut: between all its values, or at its exact quantiles where it has over ``bins`` values."""
    values: dict[int, set | None] = {f: set() for f in range(width)}
    for r in rows.select("x").mapInArrow(core.few_values(bins), "feature int, held array<double>").distinct().collect():
        known = None if r.held is None or values[r.feature] is None else values[r.feature] | set(r.held)
        values[r.feature] = None if known is None or len(known) > bins else known
    many = {f: f"f{f}" for f, v in values.items() if v is None}
    found = quantiles_of(rows.select(*[F.col("x")[f].alias(c) for f, c in many.items()]), list(many.values()), {str(i): i / bins for i in range(1, bins)}) if many else {}
    out = []
    for f, v in values.items():
        if v is not None:
            known = np.array(sorted(v))
            out.append((known[1:] + known[:-1]) / 2)
        else:
            at, times = np.unique([*found[many[f]].values()], return_counts=True)
            out.append(np.unique(np.r_[at, np.nextafter(at[times > 1], -np.inf)]))  # a frequent value is a bin of its own
    return out


class Forest:
    """An estimator of one or more settings (``trees``, ``depth``; None: no limit)."""

    def __init__(self, settings: Sequence[Mapping], seed: int = 42, features: str = "features", label: str = "label"):
        self.settings, self.seed, self.features, self.label = [dict(s) for s in settings], seed, features, label

    def fit(self, train: DataFrame) -> ForestModel:
        rows = train.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y"))
        y = F.col("y")
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(y.isNull() | F.isnan(y) | (F.abs(y) == math.inf)).alias("bad"), F.avg("y").alias("mean"),
                        F.var_pop("y").alias("var"), F.max(F.size("x")).alias("width")).first()
        if not seen.n or seen.bad:
            raise ValueError(f"a forest needs rows, each with a label: {seen.bad} of {seen.n} have none")
        return ForestModel(self, rows, seen)


class ForestModel:
    """Binned training rows and how to grow trees from them; they are grown as predictions are made, and not kept."""

    def __init__(self, forest: Forest, rows: DataFrame, seen):
        self.forest, self.rows, self.centre, self.width = forest, seen.n, seen.mean, seen.width
        self.points = split_points(rows, seen.width)
        self.subset, self.least = -(-seen.width // 3), 1e-14 * seen.n * seen.var + 1e-300
        given = [s["depth"] for s in forest.settings]
        self.limit = None if None in given else max(given)
        self.depths = sorted(set(given), key=lambda d: (d is None, d))
        self.blocks = self._packed(rows.withColumn("id", F.lit(0).cast("long")))

    def _packed(self, rows: DataFrame) -> DataFrame:
        return cut_lineage(rows.select("x", "id", "y").mapInArrow(core.packed(self.points, self.centre), _schema(core.BLOCKS)))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the prediction of the (first) setting."""
        return self.predictions(df).withColumn("prediction", F.col("predictions")[0]).drop("predictions")

    def predictions(self, df: DataFrame) -> DataFrame:
        """``df`` with a list of predictions, one for each setting."""
        held = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
        asked = self._packed(held.select(vector_to_array(self.forest.features).alias("x"), F.col("_row").alias("id"), F.lit(0.0).alias("y")))
        wanted = asked.agg(F.sum("n")).first()[0] or 0
        ends = sorted({s["trees"] for s in self.forest.settings})
        spans = list(enumerate(zip([0, *ends], ends, strict=False)))
        sums = self._whole(asked, spans) if max(self.rows, wanted) <= TREE_ROWS else self._dealt(asked, spans, max(self.rows, wanted))
        uses = [(ends.index(s["trees"]), self.depths.index(s["depth"]), s["trees"]) for s in self.forest.settings]
        ids = asked.select(F.lit(-1).cast("long").alias("span"), "block", F.lit(0).cast("long").alias("part"), "n", F.lit(b"").alias("at"), F.col("ids").alias("sums"))
        by_block = self._by(ids.unionByName(sums), max(self.rows, wanted), ["block"], ["block", "span", "part"])
        found = by_block.mapInArrow(core.averaged(uses, len(self.depths), self.centre), "_row long, predictions array<double>")
        return held.join(found, "_row").drop("_row")

    def _by(self, df: DataFrame, rows: int, keys: list[str], order: list[str]) -> DataFrame:
        cores = df.sparkSession.sparkContext.defaultParallelism
        return df.repartition(max(tasks_for(rows), TASKS_PER_CORE * cores), *keys).sortWithinPartitions(*order)

    def _draw(self) -> tuple:
        return self.forest.seed, self.subset, self.depths, self.limit, self.least

    def _whole(self, asked: DataFrame, spans: list) -> DataFrame:
        """Each tree in one task, to which all rows are broadcast; a task takes several trees, so that it sends one sum."""
        spark = asked.sparkSession
        sc = spark.sparkContext

        def sent(df):  # at most TREE_ROWS rows of some bytes
            rows = df.orderBy("block").select("block", "n", "bins", "y").collect()
            return sc.broadcast([(r.block, np.frombuffer(r.bins, np.uint8).reshape(r.n, self.width), np.frombuffer(r.y)) for r in rows])

        cores, tasks = sc.defaultParallelism, []
        for span, (a, z) in spans:
            step = max(1, -(-(z - a) // cores))
            tasks += [(span, first, min(z, first + step)) for first in range(a, z, step)]
        jobs = spark.createDataFrame(sc.parallelize(tasks, len(tasks)), "span long, first long, end long")
        return cut_lineage(jobs.mapInArrow(core.whole_trees(sent(self.blocks), sent(asked), *self._draw()), _schema(core.SUMS)))

    def _dealt(self, asked: DataFrame, spans: list, rows: int) -> DataFrame:
        """Trees of many rows, so many at a time that their rows fit ``DEALT_ROWS``."""
        sums, step = [], max(1, DEALT_ROWS // rows)
        for span, (a, z) in spans:
            for first in range(a, z, step):
                some = range(first, min(z, first + step))
                sums.append(self._dealt_trees(asked, span, some, rows))
                gc.collect()  # plans that Python still holds, then the shuffled rows of the trees that are done
                asked.sparkSession.sparkContext._jvm.System.gc()
        out = sums[0]
        for s in sums[1:]:
            out = out.unionByName(s)
        return out

    def _dealt_trees(self, asked: DataFrame, span: int, trees: Sequence[int], rows: int) -> DataFrame:
        seed, subset, depths, limit, least = self._draw()
        tops = {t: _Top(self.rows, limit) for t in trees}
        while any(top.open for top in tops.values()):
            open_ = {t: (top.arrays(), top.open) for t, top in tops.items() if top.open}
            counts = self.blocks.mapInArrow(core.node_counts(open_, seed, self.width, subset), _schema(core.COUNTS))
            cuts = self._by(counts, 1, ["tree", "node"], ["tree", "node", "part"]).mapInArrow(core.chosen_cuts(seed, self.width, subset, least), _schema(core.CUTS))
            for t in open_:
                tops[t].open = []
            for r in cuts.orderBy("tree", "node").collect():  # a row for every TREE_ROWS rows of a tree
                tops[r.tree].cut(r)
        known = {t: (top.arrays(), np.array(top.local, np.int64), np.array(top.depth)) for t, top in tops.items()}
        places = {t: k[:2] for t, k in known.items()}
        train, ask = (df.mapInArrow(core.dealt(places, seed, self.width, asked=kind), _schema(core.DEALT)) for df, kind in ((self.blocks, False), (asked, True)))
        grouped = self._by(train.unionByName(ask), rows * len(trees) // 4, ["tree", "node"], ["tree", "node", "kind", "block"])
        found = grouped.mapInArrow(core.grown_nodes(known, span, seed, self.width, subset, depths, limit, least), _schema(core.SUMS))
        return cut_lineage(self._by(found, rows, ["block"], ["block", "span", "part"]).mapInArrow(core.summed(len(depths)), _schema(core.SUMS)))


class _Top:
    """The first levels of a tree: nodes that are cut over all tasks (``open``), and nodes grown in one task each (``local``)."""

    def __init__(self, rows: int, limit: int | None):
        self.limit, self.feat, self.cuts, self.left, self.value, self.depth = limit, [], [], [], [], []
        self.open, self.local = [], []
        self._add(rows, 0.0, 0)

    def _add(self, rows: int, value: float, depth: int) -> None:
        node = len(self.feat)
        self.feat.append(-1), self.cuts.append(0), self.left.append(0), self.value.append(value), self.depth.append(depth)
        if depth and depth == self.limit:
            return
        (self.open if rows > TREE_ROWS else self.local).append(node)

    def cut(self, r) -> None:
        self.value[r.node] = r.s / r.w
        if r.feature >= 0:
            self.feat[r.node], self.cuts[r.node], self.left[r.node] = r.feature, r.cut, len(self.feat)
            self._add(r.left_n, r.left_s / r.left_w, self.depth[r.node] + 1)
            self._add(r.right_n, r.right_s / r.right_w, self.depth[r.node] + 1)

    def arrays(self) -> tuple:
        return np.array(self.feat, np.int16), np.array(self.cuts, np.uint8), np.array(self.left, np.int32), np.array(self.value)
