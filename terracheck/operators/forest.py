"""Isolation forests grown and applied as Spark jobs.

Algorithm (Liu, Ting and Zhou, 2008): every tree is grown on psi = min(256, n)
rows drawn without replacement; a node picks a random non-constant feature and a
threshold uniform between that feature's min and max in the node; growth stops
at depth ceil(log2 psi), at one row, or when all features are constant.  A
leaf's path length is its depth plus c(size), the mean unsuccessful-search
length of a BST.  ``score_samples = -2^(-mean path / c(psi))``; the offset is
the ``contamination`` quantile of the training scores; ``decision = score -
offset`` and a row is anomalous when ``decision < 0``.

Trees are unaffected by a positive per-feature affine rescale, so features are
not standardised before growth (F8 is available as an operator of its own).

Spark layout
* M1 subsample: every row has a place in every tree, ``(a_t * x + b_t) mod 2^31 - 1`` of its hash
  ``x``, and a tree takes the psi rows of the lowest places.  That is one rule for every table size,
  and trees draw independently of each other.  Tasks drop places that cannot be among the lowest
  (all but about psi + 6 sqrt(psi) a tree, by the row count), so groups stay small and a hot
  country cannot hurt.
* M2 growth: ``groupBy(model_key, tree chunk).applyInPandas`` -> node rows, with heap numbers
  (children of node i are 2 i + 1 and 2 i + 2).
* All random numbers are md5 digests of (seed, purpose, model, tree, node) or (seed, row), and path
  lengths are whole multiples of 2^-30, so sums do not depend on their order: SQL can replay a
  forest from the first draw to the last score.
* Scoring one forest: the forest is at most T x (2 psi - 1) nodes, collected
  once and broadcast to a ``mapInPandas`` that walks all trees level by level
  with numpy.
* Scoring per key (country): rows get ``salt = pmod(xxhash64(row_id), s_key)``
  with ``s_key = ceil(rows_key / rows_per_task)``; the key's forest is repeated
  per salt and ``cogroup(...).applyInPandas`` scores each (key, salt) group.
  No task holds more than ~``rows_per_task`` rows of one key.  The forest copies
  cost (rows / rows_per_task) x (<= T (2 psi - 1)) node rows: with 500,000 rows per
  group and 100 trees that is about a tenth of the row count (a few % of the bytes),
  while a group still fits a Python worker.
* Only (row id, key, salt, features) cross to Python; scores come back by row id, and no other
  column ever leaves the JVM.
* Offsets: exact quantile per model key over checkpointed (row id, key, raw score) rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracheck.functions.rand import hash_hex, hex_int
from terracheck.operators.quantiles import exact_quantile
from terracheck.session import attach_row, cut_lineage, ship_package

GLOBAL_KEY = "__global__"
EULER_GAMMA = 0.5772156649015329
MAX_PSI = 256
ROWS_PER_TASK = 500_000

NODE_SCHEMA = T.StructType(
    [
        T.StructField("model_key", T.StringType()),
        T.StructField("tree_id", T.IntegerType()),
        T.StructField("node_id", T.IntegerType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("path_len", T.DoubleType()),
    ]
)


def c_factor(n):
    """Average path length of an unsuccessful BST search over n points (vectorised), to 30 binary
    digits: sums of path lengths are then exact in any order."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out = np.where(n == 2, 1.0, out)
    big = n > 2
    safe = np.where(big, n, 3.0)
    out = np.where(big, 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe, out)
    return np.round(out * 2.0**30) / 2.0**30


def digest_int(seed: int, *parts) -> int:
    """32 bits of an md5 digest of (seed, parts); :func:`terracheck.functions.rand.hash_hex` in Python."""
    return int(hashlib.md5("|".join(map(str, (seed, *parts))).encode()).hexdigest()[:8], 16)


def node_uniform(seed: int, purpose: str, key: str, tree: int, node: int) -> float:
    """U[0, 1) of a node: independent of how trees are grouped into tasks, so growth is repeatable
    under any partitioning."""
    return digest_int(seed, purpose, key, tree, node) / 4294967296.0


def grow_trees(X: np.ndarray, tree_of_row: np.ndarray, tree_ids: np.ndarray, max_depth: int, seed: int, key: str):
    """Grow several isolation trees level by level with vectorised numpy.

    ``X`` holds the sample rows of all trees (rows x features), ``tree_of_row`` the
    position (0..k-1) of each row's tree in ``tree_ids``.  A node splits on a random
    non-constant feature at a threshold uniform in [min, max) of that feature in the
    node; it becomes a leaf at ``max_depth``, at <= 1 row, or when every feature is
    constant.  Returns a dict of node columns (tree_id, node_id, left, right, feature,
    threshold, path_len)."""
    n_feat = X.shape[1]
    levels = []
    tree, node = np.arange(tree_ids.size), np.zeros(tree_ids.size, dtype=np.int64)  # nodes of this level
    at = tree_of_row.astype(np.int64)  # the place in the level of each live row's node
    live = np.arange(X.shape[0])
    for depth in range(max_depth + 1):
        counts = np.bincount(at, minlength=tree.size)
        lo = np.full((tree.size, n_feat), np.inf)
        hi = np.full((tree.size, n_feat), -np.inf)
        np.minimum.at(lo, at, X[live])
        np.maximum.at(hi, at, X[live])
        varying = hi > lo
        n_vary = varying.sum(axis=1)
        split = (depth < max_depth) & (counts > 1) & (n_vary > 0)
        feature = np.full(tree.size, -1, dtype=np.int32)
        threshold = np.zeros(tree.size)
        places = list(zip(np.flatnonzero(split).tolist(), tree_ids[tree[split]].tolist(), node[split].tolist()))
        draws = np.array([[node_uniform(seed, purpose, key, t, i) for purpose in ("feature", "threshold")] for _, t, i in places]).reshape(-1, 2)
        choice = np.minimum((draws[:, 0] * n_vary[split]).astype(np.int64), n_vary[split] - 1)  # k-th varying feature
        rank = np.cumsum(varying[split], axis=1) - 1
        feature[split] = np.argmax((rank == choice[:, None]) & varying[split], axis=1)
        f_lo, f_hi = lo[split, feature[split]], hi[split, feature[split]]
        threshold[split] = f_lo + draws[:, 1] * (f_hi - f_lo)
        levels.append(
            {
                "tree_id": tree_ids[tree].astype(np.int32),
                "node_id": node.astype(np.int32),
                "left": np.where(split, 2 * node + 1, -1).astype(np.int32),
                "right": np.where(split, 2 * node + 2, -1).astype(np.int32),
                "feature": feature,
                "threshold": threshold,
                "path_len": np.where(split, 0.0, depth + c_factor(counts)),
            }
        )
        if not split.any():
            break
        # the rows of splitting nodes go on; both children of each such node are nodes of the next level
        slot = np.cumsum(split) - 1
        on = split[at]
        live, at = live[on], at[on]
        right = X[live, feature[at]] > threshold[at]
        at = 2 * slot[at] + right
        tree = np.repeat(tree[split], 2)
        node = (2 * node[split][:, None] + np.array([1, 2])).ravel()
    return {c: np.concatenate([level[c] for level in levels]) for c in levels[0]}


def forest_arrays(nodes: pd.DataFrame):
    """Pack the node rows of one model into arrays for vectorised traversal.

    Every tree is filled up to a full binary tree of the deepest one's depth (log2 psi at most): the
    children of place ``i`` are ``2 i + 1`` and ``2 i + 2``, and all bottom places under a leaf have
    its path length.  A walk of ``depth`` steps needs neither child pointers nor a leaf test.
    Returns (feature, threshold, path_len, depth): trees x inner places, twice, and trees x bottom
    places."""
    nodes = nodes.sort_values(["tree_id", "node_id"])
    trees, tree_of = np.unique(nodes["tree_id"].to_numpy(), return_inverse=True)
    node_id, left, right, feature = (nodes[c].to_numpy().astype(np.int64) for c in ("node_id", "left", "right", "feature"))
    width = int(node_id.max()) + 1
    row_of = np.zeros(trees.size * width, dtype=np.int64)
    row_of[tree_of * width + node_id] = np.arange(len(nodes))
    # walk down from the roots level by level: (tree, place, node row)
    tree, place = np.arange(trees.size), np.zeros(trees.size, dtype=np.int64)
    row = row_of[tree * width]
    levels = []
    while row.size:
        levels.append((tree, place, row))
        inner = feature[row] >= 0
        tree, place, row = tree[inner], place[inner], row[inner]
        row = np.concatenate([row_of[tree * width + left[row]], row_of[tree * width + right[row]]])
        tree, place = np.concatenate([tree, tree]), np.concatenate([2 * place + 1, 2 * place + 2])
    depth = len(levels) - 1
    bottom = 1 << depth
    feat = np.zeros((trees.size, bottom - 1), dtype=np.int64)
    thr = np.full((trees.size, bottom - 1), np.inf)
    plen = np.zeros((trees.size, bottom))
    threshold, path_len = nodes["threshold"].to_numpy(), nodes["path_len"].to_numpy()
    for level, (tree, place, row) in enumerate(levels):
        inner = feature[row] >= 0
        feat[tree[inner], place[inner]] = feature[row[inner]]
        thr[tree[inner], place[inner]] = threshold[row[inner]]
        leaf, under = ~inner, 1 << (depth - level)  # bottom places under a place of this level
        first = (place[leaf] + 1) * under - bottom
        plen[tree[leaf][:, None], first[:, None] + np.arange(under)] = path_len[row[leaf]][:, None]
    return feat, thr, plen, depth


#: Trees and rows that are walked at a time.
WALK_TREES, WALK_ROWS = 8, 10_000


def mean_path_length(X: np.ndarray, arrays) -> np.ndarray:
    """Average leaf path length over all trees for every row of X.

    Rows and trees are walked in blocks, so the working arrays are of one size (half a MB each)
    however many rows a group has."""
    feature, threshold, path_len, depth = arrays
    n_trees, bottom = path_len.shape
    inner = bottom - 1
    total = np.zeros(X.shape[0])
    for r0 in range(0, X.shape[0], WALK_ROWS):
        xt = np.ascontiguousarray(X[r0 : r0 + WALK_ROWS].T)  # feature-major: value of (f, row) at f * m + row
        m = xt.shape[1]
        start, rows = feature * m, np.arange(m, dtype=np.int64)
        for t0 in range(0, n_trees, WALK_TREES):
            t1 = min(n_trees, t0 + WALK_TREES)
            trees = np.arange(t0, t1, dtype=np.int64)[:, None]
            base = trees * inner
            step = 1 - base  # place 2 i + 1 of the same tree, as an index into all trees' places
            node = np.repeat(base, m, axis=1)
            if depth:  # a root is one feature and threshold for all rows
                node += 1 + ~(xt[feature[t0:t1, 0]] <= threshold[t0:t1, :1])
            for _ in range(depth - 1):  # all indices are in range; "wrap" is the quickest way to take them
                at = start.take(node, mode="wrap")
                at += rows
                right = ~(xt.take(at, mode="wrap") <= threshold.take(node, mode="wrap"))
                node *= 2
                node += step
                node += right
            node += trees * bottom - base - inner
            total[r0 : r0 + m] += path_len.take(node, mode="wrap").sum(axis=0)
    return total / n_trees


def score_samples(X: np.ndarray, arrays, psi: int) -> np.ndarray:
    """``-2^(-mean path / c(psi))``; -0.5 for a forest of one row, whose paths say nothing."""
    if psi <= 1:
        return np.full(len(X), -0.5)
    return -np.power(2.0, -mean_path_length(X, arrays) / float(c_factor(psi)))


@dataclass
class ForestModel:
    """A fitted forest: node table, per-key offsets/psi, feature order and parameters."""

    nodes: DataFrame
    offsets: DataFrame  # model_key, psi, n_train, offset
    features: tuple
    key: str | None
    contamination: float
    seed: int

    def save(self, path: str) -> None:
        """Forest, offsets and parameters as Parquet tables under ``path``."""
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.offsets.write.mode("overwrite").parquet(f"{path}/offsets")
        meta = spark.createDataFrame(
            [(",".join(self.features), self.key or "", float(self.contamination), int(self.seed))],
            "features string, key string, contamination double, seed long",
        )
        meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/params")

    @staticmethod
    def load(spark, path: str) -> "ForestModel":
        try:
            params = spark.read.parquet(f"{path}/params").first()
            nodes = spark.read.parquet(f"{path}/nodes")
            offsets = spark.read.parquet(f"{path}/offsets")
        except Exception as exc:  # AnalysisException: path does not exist
            raise FileNotFoundError(f"No saved forest at {path}; train one first.") from exc
        return ForestModel(
            nodes, offsets, tuple(params["features"].split(",")), params["key"] or None, params["contamination"], params["seed"]
        )


def _model_key_col(key: str | None):
    return F.col(key).cast("string") if key else F.lit(GLOBAL_KEY)


def model_sizes(df: DataFrame, key: str | None, min_rows: int = 1) -> DataFrame:
    """Rows per model key (NULL keys never get a model), keeping keys with >= min_rows."""
    mk = _model_key_col(key)
    base = df.where(mk.isNotNull()) if key else df
    return base.groupBy(mk.alias("model_key")).agg(F.count(F.lit(1)).alias("n_train")).where(F.col("n_train") >= min_rows)


#: Places are remainders of this prime, 2^31 - 1.
PLACES = (1 << 31) - 1


def tree_draws(n_trees: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Factor and shift of each tree: row ``x`` has place ``(a * x + b) mod PLACES`` in it."""
    a = np.array([1 + digest_int(seed, "factor", t) % (PLACES - 1) for t in range(n_trees)], dtype=np.int64)
    b = np.array([digest_int(seed, "shift", t) % PLACES for t in range(n_trees)], dtype=np.int64)
    return a, b


def folded(v: np.ndarray) -> np.ndarray:
    """``v mod PLACES`` for 0 <= v < PLACES^2: one fold leaves less than 2 PLACES, and an unsigned
    difference below zero is larger than any place."""
    low = ((v & PLACES) + (v >> 31)).astype(np.uint32)
    return np.minimum(low, low - np.uint32(PLACES))


def subsample(
    df: DataFrame,
    sizes: DataFrame,
    key: str | None,
    n_trees: int,
    seed: int,
    row_id: str = "row_id",
    max_psi: int = MAX_PSI,
) -> DataFrame:
    """M1: for every model key and tree, exactly psi = min(max_psi, n) rows without replacement.

    A tree takes the psi rows with the lowest places; rows of one place, which have equal hashes, go
    by a digest of row and tree. The rule knows no table size. Tasks only pass on places below
    ``(psi + 6 sqrt(psi) + 10) / n`` of the range; fewer than psi of them in a tree is a > 6-sigma
    event.  Work is n T multiplications in numpy, T (psi + 6 sqrt(psi)) rows are shuffled, and no
    group exceeds ~1.15 times that of a tree."""
    ship_package(df.sparkSession)
    wanted = sizes.withColumn("psi", F.least(F.lit(max_psi), F.col("n_train")).cast("int"))
    share = F.least(F.lit(1.0), (F.col("psi") + 6 * F.sqrt("psi") + 10) / F.col("n_train"))
    wanted = wanted.withColumn("_limit", F.floor(share * PLACES))
    if key is None:  # one model: one row, attached without a join key
        rows = attach_row(df, wanted)
    else:
        rows = df.withColumn("model_key", _model_key_col(key)).join(wanted, "model_key")
    rows = rows.withColumn("_x", hex_int(hash_hex(seed, "row", F.col(row_id)), 1, 8) % PLACES)
    schema = T.StructType([*rows.schema.fields, T.StructField("tree_id", T.IntegerType()), T.StructField("_place", T.LongType())])
    at_x, at_limit = rows.columns.index("_x"), rows.columns.index("_limit")
    a, b = tree_draws(n_trees, seed)
    block = max(1, (1 << 16) // n_trees)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, limit = batch.column(at_x).to_numpy(), batch.column(at_limit).to_numpy().astype(np.uint32)
            low, held = [], 0  # (row, tree, place) of the low places, passed on about 2^18 at a time
            for i in range(0, len(x), block):
                v = folded(x[i : i + block, None] * a + b)
                row, tree = np.nonzero(v <= limit[i : i + block, None])
                low.append((row + i, tree.astype(np.int32), v[row, tree].astype(np.int64)))
                held += row.size
                if held >= 1 << 18 or i + block >= len(x):
                    row, tree, place = (np.concatenate(c) for c in zip(*low))
                    low, held = [], 0
                    yield pa.RecordBatch.from_arrays([*batch.take(pa.array(row)).columns, pa.array(tree), pa.array(place)], names=schema.names)

    order = ["_place", hash_hex(seed, "tie", F.concat_ws("|", F.col("tree_id").cast("string"), F.col(row_id).cast("string"))), row_id]
    w = Window.partitionBy("model_key", "tree_id").orderBy(*order)
    low = rows.mapInArrow(places, schema).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= F.col("psi"))
    return low.drop("_rn", "_place", "_x", "_limit")


def grow_forest(sample: DataFrame, features, seed: int, row_id: str = "row_id", trees_per_group: int = 16) -> DataFrame:
    """M2: trees grown by ``applyInPandas`` over (model_key, tree chunk) groups of at most
    ``trees_per_group`` x psi rows -> node rows."""
    feats = list(features)
    ship_package(sample.sparkSession)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tree_id", row_id])
        key = str(pdf["model_key"].iloc[0])
        psi = int(pdf["psi"].iloc[0])
        tree_ids, tree_of_row = np.unique(pdf["tree_id"].to_numpy(), return_inverse=True)
        max_depth = int(math.ceil(math.log2(max(psi, 2))))
        cols = grow_trees(pdf[feats].to_numpy(dtype=float), tree_of_row, tree_ids, max_depth, seed, key)
        out = pd.DataFrame(cols)
        out.insert(0, "model_key", key)
        return out[[f.name for f in NODE_SCHEMA.fields]]

    cols = ["model_key", "tree_id", "psi", row_id, *feats]
    # Explicit hash partitioning on the group keys: AQE does not coalesce it, so the
    # (cheap to shuffle, CPU-heavy) tree groups spread over all Python workers.
    parts = python_parallelism(sample.sparkSession)
    chunk = (F.col("tree_id") / trees_per_group).cast("int").alias("_chunk")
    return (
        sample.select(*cols, chunk)
        .repartition(parts, "model_key", "_chunk")
        .groupBy("model_key", "_chunk")
        .applyInPandas(grow, NODE_SCHEMA)
    )


def python_parallelism(spark) -> int:
    """Partitions for Python-heavy group stages: at least the shuffle setting and 2x the cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


#: A table of models with no more rows is broadcast (one row a model, fixed width).
MAX_BROADCAST_MODELS = 10_000


def with_size_hint(models: DataFrame) -> DataFrame:
    """``models``, a stored table of one row a model, to be broadcast if a count finds it small: the
    rows that it is joined with then stay where they are, however few keys they share."""
    few = models.limit(MAX_BROADCAST_MODELS + 1).count() <= MAX_BROADCAST_MODELS
    return F.broadcast(models) if few else models


def _add_double(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(name, T.DoubleType())])


def score_single(df: DataFrame, nodes_pdf: pd.DataFrame, psi: int, features, out: str = "_raw") -> DataFrame:
    """Score every row with one forest given as collected node rows (bounded size).

    A scalar Pandas UDF over a struct of the feature columns: only the features
    cross to Python (Arrow batches), the rest of the row stays in the JVM."""
    spark = df.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast(forest_arrays(nodes_pdf))

    @F.pandas_udf(T.DoubleType())
    def forest_score(x: pd.DataFrame) -> pd.Series:
        return pd.Series(score_samples(x.to_numpy(dtype=float), bc.value, psi))

    return df.withColumn(out, forest_score(F.struct(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])))


def raw_per_key(
    df: DataFrame,
    nodes: DataFrame,
    sizes: DataFrame,
    key: str,
    features,
    row_id: str = "row_id",
    out: str = "_raw",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``(row_id, model_key, out)`` of the rows whose key has a forest, through a salted cogroup.
    ``sizes`` holds (model_key, n_train, psi) of the trained keys.

    One shuffle of the narrow rows, by (key, salt): a trained key with n rows gets
    ceil(n / rows_per_task) salts.  Rows without a forest (NULL key, too few rows) take no part."""
    feats = list(features)
    spark = df.sparkSession
    ship_package(spark)
    parts = python_parallelism(spark)
    salts = sizes.select(
        "model_key", "psi", F.greatest(F.lit(1), F.ceil(F.col("n_train") / rows_per_task)).cast("int").alias("_salts")
    )
    rows = (
        df.select(row_id, F.col(key).cast("string").alias("model_key"), *[F.col(f).cast("double").alias(f) for f in feats])
        .join(salts.select("model_key", "_salts"), "model_key")
        .withColumn("_salt", F.pmod(F.xxhash64(F.col(row_id)), F.col("_salts")).cast("int"))
        .drop("_salts")
    )
    forest = nodes.join(salts, "model_key").select("*", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"))
    forest = forest.drop("_salts")
    out_schema = _add_double(rows.select(row_id, "model_key").schema, out)
    names = out_schema.fieldNames()

    def fn(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in names})
        left[out] = score_samples(left[feats].to_numpy(dtype=float), forest_arrays(right), int(right["psi"].iloc[0]))
        return left[names]

    rows = rows.repartition(parts, "model_key", "_salt")
    forest = forest.repartition(parts, "model_key", "_salt")
    return (
        rows.groupBy("model_key", "_salt")
        .cogroup(forest.groupBy("model_key", "_salt"))
        .applyInPandas(fn, out_schema)
    )


def score_per_key(
    df: DataFrame, nodes: DataFrame, sizes: DataFrame, key: str, features, row_id: str = "row_id", out: str = "_raw", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Every row of ``df`` with the score of its key's forest; NULL where there is none."""
    raw = raw_per_key(df, nodes, sizes, key, features, row_id, out, rows_per_task)
    return df.join(raw.drop("model_key"), row_id, "left")


def fit_forest(
    df: DataFrame,
    features,
    key: str | None = None,
    n_trees: int = 100,
    contamination: float = 0.08,
    seed: int = 42,
    min_rows: int = 1,
    row_id: str = "row_id",
    max_psi: int = MAX_PSI,
):
    """Fit one forest (key=None) or one per key value with >= min_rows rows, and score the
    training rows.  Returns ``(model, scored)`` where ``scored`` is ``df`` plus ``_raw``
    (score_samples, NULL for rows without a model) and ``_decision`` (raw - offset)."""
    sizes = cut_lineage(model_sizes(df, key, min_rows).withColumn("psi", F.least(F.lit(max_psi), F.col("n_train")).cast("int")))
    trained = sizes.first()
    if trained is None:
        if key is None:
            raise ValueError("cannot fit a forest on an empty table")
        # no key has enough rows: every row falls back (no model, NULL scores)
        empty_nodes = df.sparkSession.createDataFrame([], NODE_SCHEMA)
        offsets = sizes.withColumn("offset", F.lit(None).cast("double"))
        model = ForestModel(empty_nodes, offsets, tuple(features), key, contamination, seed)
        scored = df.withColumns({"_raw": F.lit(None).cast("double"), "_decision": F.lit(None).cast("double")})
        return model, scored
    narrow = df.select(row_id, *([key] if key else []), *features)
    models = with_size_hint(sizes)
    sample = subsample(narrow, models.drop("psi"), key, n_trees, seed, row_id, max_psi)
    nodes = cut_lineage(grow_forest(sample, features, seed, row_id))
    if key is None:
        raw = score_single(narrow, nodes.toPandas(), int(trained["psi"]), features).select(row_id, F.lit(GLOBAL_KEY).alias("model_key"), "_raw")
    else:
        raw = raw_per_key(narrow, nodes, models, key, features, row_id)
    raw = cut_lineage(raw)  # the Python scoring runs once; offsets and labels both read these narrow rows
    offsets = cut_lineage(sizes.join(exact_quantile(raw, "_raw", contamination, ["model_key"], "offset"), "model_key", "left"))
    model = ForestModel(nodes, offsets, tuple(features), key, contamination, seed)
    decided = raw.join(with_size_hint(offsets).select("model_key", "offset"), "model_key").select(row_id, "_raw", (F.col("_raw") - F.col("offset")).alias("_decision"))
    return model, df.join(decided, row_id, "left")


def apply_offsets(scored: DataFrame, model: ForestModel) -> DataFrame:
    """``_decision = _raw - offset`` of the row's model."""
    mk = _model_key_col(model.key)
    offs = model.offsets.select(F.col("model_key").alias("_mk"), F.col("offset").alias("_offset"))
    return scored.join(offs, mk == F.col("_mk"), "left").withColumn("_decision", F.col("_raw") - F.col("_offset")).drop("_mk", "_offset")


def score_forest(df: DataFrame, model: ForestModel, row_id: str = "row_id") -> DataFrame:
    """M3/M5 with a saved model: ``_raw`` and ``_decision`` for new rows."""
    if model.key is None:
        psi = int(model.offsets.first()["psi"])
        scored = score_single(df, model.nodes.toPandas(), psi, model.features)
    else:
        # groups are sized by the rows that are scored, which may be many more than were trained on
        here = cut_lineage(model_sizes(df, model.key).join(model.offsets.select("model_key", "psi"), "model_key"))
        scored = score_per_key(df, model.nodes, with_size_hint(here), model.key, model.features, row_id)
    return apply_offsets(scored, model)
