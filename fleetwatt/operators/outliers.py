"""Isolation forest over telemetry features.

Follows Liu, Ting and Zhou, "Isolation Forest", ICDM 2008. Fitting needs only a
small sample per tree; scoring is a vectorized pass over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from fleetwatt.plans.lineage import stored
from fleetwatt.plans.skew import SALT, attach_group, exact_quantile, salt_rows
from fleetwatt.schema import KEYS

SAMPLE_SIZE = 256
_TREE_SCHEMA = (
    "tree int, node int, feature int, split double, left_node int, right_node int, path double"
)


def _average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[list]:
    """Nodes of one tree: [feature, split, left, right, path length at a leaf]."""
    nodes: list[list] = []
    pending = [(points, 0, None)]
    while pending:
        part, depth, parent = pending.pop()
        here = len(nodes)
        nodes.append([-1, 0.0, here, here, depth + _average_path(len(part))])
        if parent is not None:
            nodes[parent[0]][parent[1]] = here
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= max_depth or len(part) <= 1 or usable.size == 0:
            continue
        feature = int(rng.choice(usable))
        split = float(rng.uniform(low[feature], high[feature]))
        if split >= high[feature]:  # neighbouring doubles: the draw can round up
            split = float(low[feature])
        goes_left = part[:, feature] <= split
        nodes[here][0], nodes[here][1] = feature, split
        pending.append((part[~goes_left], depth + 1, (here, 3)))
        pending.append((part[goes_left], depth + 1, (here, 2)))
    return nodes


def _sample(df: DataFrame, features, keys, trees, seed, size) -> DataFrame:
    """At most `size` rows per tree: one rule for every size of table.

    The size * trees rows of smallest hash are a pool, in the order of the hash. The trees take
    `size` places each, one tree after the other, and begin anew at the pool's end; a row that a
    tree meets twice counts once. All depends on the rows only, not on partitions.
    """
    places = size * trees
    pool = df.select(*features, *keys, F.xxhash64(*keys, F.lit(seed)).alias("_draw")).orderBy("_draw", *keys).limit(places)
    # The pool is bounded, so one task may number it.
    numbered = pool.withColumn("_rank", F.row_number().over(Window.orderBy("_draw", *keys)) - 1)
    n = F.count(F.lit(1)).over(Window.partitionBy())
    rounds = F.explode(F.sequence(F.lit(0), F.floor((places - 1 - F.col("_rank")) / F.col("_n")).cast("int")))
    taken = numbered.withColumn("_n", n).withColumn("_round", rounds)
    tree = F.floor((F.col("_rank") + F.col("_round") * F.col("_n")) / size).cast("int")
    return taken.withColumn("tree", tree).dropDuplicates(["tree", "_rank"]).select("tree", F.col("_rank").alias("_place"), *features)


def fit_forest(
    df: DataFrame,
    features: list[str],
    trees: int = 100,
    seed: int = 42,
    size: int = SAMPLE_SIZE,
    keys: list[str] | None = None,
) -> DataFrame:
    """Trees as rows, one per node. Each group holds at most `size` rows."""
    depth = int(np.ceil(np.log2(size)))

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        points = rows.sort_values("_place")[features].to_numpy(dtype=float)
        nodes = _grow(points, np.random.default_rng([seed, tree]), depth)
        made = pd.DataFrame(nodes, columns=["feature", "split", "left_node", "right_node", "path"])
        made.insert(0, "node", np.arange(len(nodes)))
        made.insert(0, "tree", tree)
        return made

    sample = _sample(df, features, keys or KEYS, trees, seed, size)
    # A set number of partitions: the sample is small, and would be fitted by one task.
    spread = sample.repartition(min(trees, 64), "tree")
    return spread.groupBy("tree").applyInPandas(fit, _TREE_SCHEMA)


def _scores(points: np.ndarray, trees: list[tuple], size: int) -> np.ndarray:
    """Scores of points by trees of (feature, split, left, right, path); size: rows fitted per tree."""
    depth = max(1, int(np.ceil(np.log2(size))))
    rows, length = np.arange(len(points)), np.zeros(len(points))
    for feature, split, left, right, path in trees:
        at = np.zeros(len(points), dtype=np.int64)
        for _ in range(depth):
            # Leaves point to themselves, so a finished row stays put.
            below = points[rows, np.maximum(feature[at], 0)] <= split[at]
            at = np.where(below, left[at], right[at])
        length += path[at]
    return np.exp2(-length / (len(trees) * _average_path(size)))


def score_rows(df: DataFrame, features: list[str], forest: DataFrame, size: int) -> DataFrame:
    """Add the anomaly score, in (0, 1); higher is more isolated. size: rows fitted per tree.

    The forest passes through the driver to be broadcast. It has at most
    2 * size - 1 nodes per tree, whatever the size of the table.
    """
    nodes = forest.toPandas().sort_values(["tree", "node"])
    parts = [
        (t["feature"].to_numpy(), t["split"].to_numpy(), t["left_node"].to_numpy(),
         t["right_node"].to_numpy(), t["path"].to_numpy())
        for _, t in nodes.groupby("tree")
    ]
    shared = df.sparkSession.sparkContext.broadcast(parts)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(_scores(np.column_stack([c.to_numpy(dtype=float) for c in batch]), shared.value, size))

    return df.withColumn("anomaly_score", score(*features))


def isolation_outliers(
    df: DataFrame,
    features: list[str] | None = None,
    contamination: float = 0.05,
    trees: int = 100,
    seed: int = 42,
    size: int = SAMPLE_SIZE,
    keys: list[str] | None = None,
) -> DataFrame:
    """Label every complete row: the given share with the highest scores is -1.

    Eager: it runs its passes while the result is built. The complete rows and the scores are each stored once, in the cluster's
    shared folder: count, sample, scoring, cut and labels are then plain passes
    over narrow tables.
    """
    features = features or ["inverter_temp_c", "inverter_efficiency_pct"]
    keys = keys or KEYS
    complete = stored(df.select(*keys, *features).dropna(subset=features), "features")
    forest = fit_forest(complete, features, trees, seed, size, keys)
    fitted = max(2, min(size, complete.count()))
    scored = stored(score_rows(complete, features, forest, fitted), "scores")
    cut = exact_quantile(scored, [], "anomaly_score", 1.0 - contamination, "cut").scalar()
    is_outlier = F.col("anomaly_score") > F.col("_cut")
    return (
        scored.withColumn("_cut", cut)
        .withColumn("label", F.when(is_outlier, -1).otherwise(1))
        .drop("_cut")
    )


# --- a forest per group ------------------------------------------------------------------

GROUP = "_group"
_PARTS = ["feature", "split", "left_node", "right_node", "path"]
SCORED_TOGETHER = 100_000


def _pools(rows: DataFrame, features, keys, trees, seed, size) -> DataFrame:
    """The rows of smallest hash of each group, size * trees at most, with the trees that draw them.

    Spark ranks before and after the shuffle, so of a group of any size each task passes on no
    more than a pool. Draws are those of one forest: see _sample.
    """
    places = size * trees
    draw = F.xxhash64(*keys, F.lit(seed))
    order = Window.partitionBy(GROUP).orderBy("_draw", *keys)
    pool = rows.select(GROUP, *features, *keys, draw.alias("_draw")).withColumn("_rank", F.row_number().over(order))
    pool = pool.where(F.col("_rank") <= places).withColumn("_rank", F.col("_rank") - 1)
    numbered = pool.withColumn("_n", F.count("*").over(Window.partitionBy(GROUP)))
    rounds = F.explode(F.sequence(F.lit(0), F.floor((places - 1 - F.col("_rank")) / F.col("_n")).cast("int")))
    taken = numbered.withColumn("_round", rounds)
    tree = F.floor((F.col("_rank") + F.col("_round") * F.col("_n")) / size).cast("int")
    drawn = taken.withColumn("tree", tree).dropDuplicates([GROUP, "tree", "_rank"])
    return drawn.select(GROUP, "tree", F.col("_rank").alias("_place"), *features)


def fit_forests(rows: DataFrame, features: list[str], keys: list[str], trees: int, seed: int, size: int) -> DataFrame:
    """One row per group and tree, its nodes packed in arrays (2 * size - 1 at most)."""
    depth = int(np.ceil(np.log2(size)))

    def fit(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        points = sample.sort_values("_place")[features].to_numpy(dtype=float)
        nodes = list(zip(*_grow(points, np.random.default_rng([seed, int(key[1])]), depth)))
        return pd.DataFrame({GROUP: [key[0]], "tree": [int(key[1])], **{n: [list(v)] for n, v in zip(_PARTS, nodes)}})

    schema = f"{GROUP} string, tree int, feature array<int>, split array<double>, left_node array<int>, right_node array<int>, path array<double>"
    sample = _pools(rows, features, keys, trees, seed, size)
    return sample.groupBy(GROUP, "tree").applyInPandas(fit, schema)


def isolation_outliers_by(
    df: DataFrame,
    by: list[str],
    features: list[str] | None = None,
    contamination: float = 0.05,
    trees: int = 100,
    seed: int = 42,
    size: int = SAMPLE_SIZE,
    keys: list[str] | None = None,
) -> DataFrame:
    """A forest, scores and a cut per group: keys, by, features, anomaly_score, label (-1 for outliers).

    Rows without a feature are left out; NULL is a group of its own. A group's rows are scored in
    parts of bounded size, each met by the group's packed trees; no forest passes through the driver.
    Eager, as isolation_outliers.
    """
    features = features or ["inverter_temp_c", "inverter_efficiency_pct"]
    keys = keys or KEYS
    columns = list(dict.fromkeys([*keys, *by, *features]))
    group = F.to_json(F.struct(*by)).alias(GROUP)
    complete = stored(df.select(*columns, group).dropna(subset=features), "group_features")
    forests = fit_forests(complete, features, keys, trees, seed, size)
    sizes = complete.groupBy(GROUP).agg(F.count("*").alias("_n")).select(GROUP, "_n", F.ceil(F.col("_n") / SCORED_TOGETHER).cast("int").alias("_parts"))
    cut_in = sizes.select(GROUP, F.col("_parts").alias("_in"))
    parted = complete.join(cut_in, GROUP).withColumn("_part", F.pmod(F.xxhash64(F.lit(seed), *keys), F.col("_in")).cast("int")).drop("_in")
    packed = forests.join(sizes, GROUP).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))

    def score(rows: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        fitted = max(2, min(size, int(nodes["_n"].iloc[0])))
        made = [tuple(np.asarray(t[n]) for n in _PARTS) for _, t in nodes.sort_values("tree").iterrows()]
        out = rows[columns].copy()
        out["anomaly_score"] = _scores(rows[features].to_numpy(dtype=float), made, fitted)
        return out

    schema = T.StructType([complete.schema[c] for c in columns] + [T.StructField("anomaly_score", T.DoubleType())])
    both = parted.groupBy(GROUP, "_part").cogroup(packed.groupBy(GROUP, "_part"))
    scored = stored(both.applyInPandas(score, schema), "group_scores")
    salts = 32
    cuts = exact_quantile(scored, by, "anomaly_score", 1.0 - contamination, "_cut")
    labelled = attach_group(salt_rows(scored, keys, salts), cuts, by, salts).drop(SALT)
    return labelled.withColumn("label", F.when(F.col("anomaly_score") > F.col("_cut"), -1).otherwise(1)).drop("_cut")


def outlier_counts(labelled: DataFrame, by: list[str], planted: str | None = None) -> DataFrame:
    """Rows and outliers per group; with a condition on planted rows also these, and how many were found."""
    found = F.col("label") == -1
    counts = [F.count("*").alias("n_rows"), F.count_if(found).alias("n_outliers")]
    if planted is not None:
        counts += [F.count_if(F.expr(planted)).alias("n_planted"), F.count_if(F.expr(planted) & found).alias("n_found")]
    return labelled.groupBy(*by).agg(*counts)
