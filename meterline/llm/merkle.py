"""A Merkle manifest of a table: a hash tree per source, and one over the sources' roots.

A leaf is the digest of a row's columns, each ``-`` for null or its length in bytes, a
colon and its value. Nodes of a tree stand in order; FANOUT in a row make a run, whose
digest is the node above. A tree is grown level by level until one node is left.

1. Rows are sorted by tree and id over all tasks and numbered without gaps: tasks count
   their rows of each tree, and running sums of these counts are the tasks' offsets.
2. On each level, lag and lead columns at the fixed offsets 1 to FANOUT - 1, masked by
   the node's slot in its run and by the run's length, are its siblings. The first child
   of a run hashes the parent.
3. Back down, each node puts its siblings before its parent's path. A row's path leads
   to the root of the whole table, and folds its leaf, or any other, up to a root.

The window of the lag and lead columns is one run, so a source of any size is spread
over all tasks. Levels are written to the shared folder. Only the number of the largest
tree's leaves and the root reach the driver.

Defined results: null ids come first, rows of equal id stand in order of their leaves,
and equal rows are leaves side by side. Null sources are a tree of their own, before all
others; an empty source is another. Texts of any length are hashed whole. An empty table
gives an empty result. Columns that are not named are left out and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import stored

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: A row's number within its task is kept in so many low bits of its increasing id.
NUMBER_BITS = 33
STEPS = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(columns: list[Column]) -> Column:
    """The digest of the values, each told apart from null and from its neighbours by its length."""
    texts = [column.cast("string") for column in columns]
    marked = [F.concat(F.octet_length(text).cast("string"), F.lit(":"), text) for text in texts]
    return digest(F.concat(*(F.coalesce(text, F.lit("-")) for text in marked)))


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(steps, leaf, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def proof_digest(steps: Column) -> Column:
    """The digest of all siblings on a path, from the leaf up, left to right."""
    return digest(F.array_join(F.transform(steps, lambda step: F.concat(step["left"], step["right"])), ""))


def numbered(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """The rows with their place ``pos`` in their ``tree`` and its size ``n``.

    Sorted rows are written with an id that rises over tasks and within them, so that
    counts and places come from one and the same dealing.
    """
    keys = ["tree", *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = stored(ranged.withColumn("at", F.monotonically_increasing_id()), purpose)
    laid = laid.withColumn("task", F.shiftright("at", NUMBER_BITS))
    parts = laid.groupBy("tree", "task").agg(F.min("at").alias("first"), F.count("*").alias("count"))
    before = Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "tree",
        "task",
        (F.coalesce(F.sum("count").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("count").over(Window.partitionBy("tree")).alias("n"),
    )
    places = laid.join(parts, ["tree", "task"]).withColumn("pos", F.col("at") + F.col("shift"))
    return stored(places.select(*rows.columns, "pos", "n"), f"{purpose}-numbered")


#: One run of nodes; the siblings of each are columns at fixed offsets, masked by slot and run length.
WITHIN = "OVER (PARTITION BY tree, up ORDER BY pos)"
LEFT = ", ".join(f"IF(slot >= {k}, lag(node, {k}) {WITHIN}, NULL)" for k in range(FANOUT - 1, 0, -1))
RIGHT = ", ".join(f"IF(slot + {k} < run, lead(node, {k}) {WITHIN}, NULL)" for k in range(1, FANOUT))


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with the siblings ``left`` and ``right`` of them in their run, and the run's number ``up``."""
    runs = nodes.selectExpr("*", f"pos div {FANOUT} AS up", f"pos % {FANOUT} AS slot")
    runs = runs.selectExpr("*", f"least({FANOUT}, n - up * {FANOUT}) AS run")
    return runs.selectExpr("*", f"concat_ws('', {LEFT}) AS left", f"concat_ws('', {RIGHT}) AS right")


def grown(leaves: DataFrame) -> list[DataFrame]:
    """The levels of all trees, from the leaves up; a tree ends on the level where its ``n`` is 1."""
    levels, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        family = with_siblings(levels[-1].filter("n > 1").select("tree", "pos", "n", "node"))
        parents = family.filter("slot = 0").select(
            "tree",
            F.col("up").alias("pos"),
            F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
            digest(F.concat("node", "right")).alias("node"),
        )
        levels.append(stored(parents, "tree-level"))
        most = -(-most // FANOUT)
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, node): the last node of each tree."""
    found = [level.filter("n = 1").select("tree", "node") for level in levels]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with their ``steps`` and the columns of ``tops``.

    ``tops`` has a row per tree: the ``steps`` from its root on, and what else its nodes are to have.
    """
    others = [name for name in tops.columns if name not in ("tree", "steps")]
    above = None
    for number in reversed(range(len(levels))):
        level = levels[number]
        kept = [name for name in level.columns if name not in ("tree", "pos", "n")]
        whole = level.filter("n = 1").join(tops, "tree").select("tree", "pos", *kept, "steps", *others)
        if above is not None:
            own = F.array(F.struct("left", "right"))
            parents = above.select("tree", F.col("pos").alias("up"), F.col("steps").alias("rest"), *others)
            inner = with_siblings(level.filter("n > 1")).join(parents, ["tree", "up"])
            inner = inner.select("tree", "pos", *kept, F.concat(own, "rest").alias("steps"), *others)
            whole = whole.unionByName(inner)
        above = stored(whole.drop("node"), "tree-paths") if number else whole
    return above


def merkle_manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    id_col: str = "doc_id",
    tree_col: str = "source",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """A row per row: ``id_col``, leaf, subroot (its tree's root), root, steps, and what to ``carry``.

    ``steps`` has the siblings left and right of the row's node on every level up to the
    root, for ``folded`` and ``proof_digest``. ``carry`` are columns computed from the row.
    """
    carry = carry or {}
    source = F.col(tree_col).cast("string")
    rows = docs.select(
        # Null before the empty text, both before all others, in the order of their bytes.
        F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source)).alias("tree"),
        F.col(id_col).alias("id"),
        leaf([F.col(name) for name in columns]).alias("node"),
        F.struct(F.lit(True).alias("here"), *(value.alias(name) for name, value in carry.items())).alias("carried"),
    )
    levels = grown(numbered(rows, ["id", "node"], "leaves"))
    subroots = roots(levels).select(F.lit("").alias("tree"), F.col("tree").alias("source"), "node")
    upper = grown(numbered(subroots, ["source"], "subroots"))
    last = roots(upper).select("node").first()
    root = last["node"] if last else None
    summit = upper[0].select("tree").distinct().withColumn("steps", F.array().cast(STEPS))
    tops = stored(paths(upper, summit).select(
        F.col("source").alias("tree"), "steps", F.col("node").alias("subroot")
    ), "subroot-paths")
    return paths(levels, tops).select(
        F.col("id").alias(id_col),
        F.col("node").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        "steps",
        *(F.col("carried")[name].alias(name) for name in carry),
    )
