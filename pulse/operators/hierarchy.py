"""Transitive closure of a parent-pointer tree (code -> root)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.session import ensure_checkpoint_dir


#: Depth from which the edges are counted to tell a deep tree from a cycle.
CYCLE_CHECK_FROM = 32


def root_closure(tree: DataFrame, code: str = "code", parent: str = "parent",
                 checkpoint_every: int = 4,
                 cached: list | None = None) -> DataFrame:
    """Map every node reachable from a root to that root.

    Seed = nodes whose parent is NULL (root = itself); each round joins the
    tree's child edges to the current frontier, so a child inherits its
    parent's root.  Orphans (parent missing) and nodes on cycles are never
    reached and are absent from the output, as in a recursive CTE.

    Each round is one shuffle join of the edge list with the frontier plus
    one count (the stop test) over the persisted frontier.  Every
    ``checkpoint_every`` rounds the frontier is checkpointed into the shared
    checkpoint folder, which bounds the lineage: a lost executor recomputes
    at most that many rounds.  Persisted frontiers are appended to ``cached``
    (when given) so the caller can release them once results are written.
    Returns (code, root).
    """
    spark = tree.sparkSession
    ensure_checkpoint_dir(spark)
    edges = (tree.select(F.col(code).alias("_child"), F.col(parent).alias("_parent"))
             .filter(F.col("_parent").isNotNull()))
    frontier = (tree.filter(F.col(parent).isNull())
                .select(F.col(code).alias("code"), F.col(code).alias("root"))
                .persist(StorageLevel.MEMORY_AND_DISK))
    levels = [frontier]
    held = cached if cached is not None else []
    held.append(frontier)
    n = frontier.count()
    depth, longest = 0, None
    while n:
        depth += 1
        if longest is None and depth > CYCLE_CHECK_FROM:
            longest = edges.count()
        if longest is not None and depth > longest + 1:  # a path longer than all edges passes one twice
            raise RuntimeError("the hierarchy has a cycle under a root")
        nxt = (edges.join(frontier, edges._parent == frontier.code)
               .select(F.col("_child").alias("code"), F.col("root")))
        if checkpoint_every and depth % checkpoint_every == 0:
            nxt = nxt.checkpoint(eager=True)
        else:
            nxt = nxt.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(nxt)
        n = nxt.count()
        if n:
            levels.append(nxt)
        frontier = nxt
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def doubled_closure(tree: DataFrame, code: str = "code", parent: str = "parent",
                    rounds: list | None = None) -> DataFrame:
    """:func:`root_closure` by pointer doubling, for deep trees: (code, root).

    Every node points to its parent, a root is where pointers end.  In a round
    each node that does not point to a root yet takes over the pointer of the
    node it points to, so after k rounds it points 2^k steps up: a tree of depth
    d takes log2(d) rounds instead of d.  Nodes whose pointer names no node
    (orphans and what hangs below them) drop out in the join.  Depths are
    without gaps, so a round in which no node reaches a root means that the rest
    never will: they are on cycles or below them, and are left out.

    A round is one shuffle join on the code, checkpointed in the shared folder;
    nodes that have their root are not joined again.  ``rounds``, when given,
    receives (reached a root, still on the way) of every round.
    """
    ensure_checkpoint_dir(tree.sparkSession)
    own, up = F.col(code), F.col(parent)
    settled = [tree.filter(up.isNull()).select(own.alias("code"), own.alias("up"))]
    active = tree.filter(up.isNotNull()).select(own.alias("code"), up.alias("up"))
    while True:
        pointers = active.select("code", "up", F.lit(False).alias("done"))
        for part in settled:
            pointers = pointers.unionByName(part.select("code", "up", F.lit(True).alias("done")))
        ends = pointers.select(F.col("code").alias("_at"), F.col("up").alias("_next"), "done")
        step = (active.join(ends, active["up"] == ends["_at"])
                .select("code", F.col("_next").alias("up"), "done").checkpoint())
        reached, left = step.agg(F.count_if("done"), F.count_if(~F.col("done"))).first()
        if rounds is not None:
            rounds.append((reached, left))
        settled.append(step.filter("done").select("code", "up"))
        active = step.filter(~F.col("done")).select("code", "up")
        if not reached or not left:
            break
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out.select("code", F.col("up").alias("root"))


def closure_with_labels(tree: DataFrame, code: str = "code", parent: str = "parent",
                        label: str = "label", closure=root_closure, **kw) -> DataFrame:
    """(code, code_label, root_code, root_label): closure joined to own and root labels.

    Inner joins, as in the original model: a node whose label row is
    missing drops out.  ``closure`` is how the roots are found.
    """
    cl = closure(tree, code, parent, **kw)
    own = tree.select(F.col(code).alias("_k"), F.col(label).alias("code_label"))
    rl = tree.select(F.col(code).alias("_r"), F.col(label).alias("root_label"))
    return (cl.join(rl, cl.root == rl._r)
              .join(own, cl.code == own._k)
              .select("code", "code_label", F.col("root").alias("root_code"), "root_label"))
