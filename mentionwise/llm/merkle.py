"""Merkle manifest of a dataset, with a proof for every row, by pointer jumping.

Every row is a leaf: the digest of its fields. Within each group the leaves ascend by
key; runs of ``fanout`` consecutive nodes become the digest of their digests, level by
level, until one node, the group's subroot, is left. The subroots, ordered by group,
become the root in the same way.

A node holds the segment of its siblings' digests on the way to its parent. Self-joins
then double the distance: a node takes over the segment of the ancestor it points at,
so after k joins a segment reaches 2^k levels up. Nodes that no leaf's pointer can land
on any more leave the table, so it soon holds little but the leaves. Where few nodes
are landed on, each by very many, their table is counted and broadcast; otherwise no
node has a large share of the rows.

Positions come from a range sort over all rows, not from a window per group, so a group
of a third of all rows is spread over many tasks.

Edge cases: null fields count as ``-``; a null group is a group of its own and comes
first; null keys come first. Rows that share a key are ordered by their leaf; equal rows
are leaves of their own. A lone leaf is its group's subroot, a lone subroot the root, with
empty proofs. An empty table has no rows in its manifest. Only the named columns are read,
so others may have any name; texts are digested whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionwise.llm.alignment import quoted
from mentionwise.llm.components import join_counted
from mentionwise.llm.scratch import Scratch
from mentionwise.session import shuffle_partitions

# levels that are built from one run of consecutive nodes in one task
LEVELS_AT_ONCE = 9
# a table of ancestors is broadcast if it takes up to so many bytes, with so many for a row beside its segment
BROADCAST_BYTES = 8 * 1024 * 1024
ROW_BYTES = 96
HEX = 64


def digest(*parts: Column) -> Column:
    """Lower-case hex of the SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: list[Column]) -> Column:
    """The digest of a row's fields: each its length in bytes, a colon and the value, or ``-``."""
    texts = [f.cast("string") for f in fields]
    return digest(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ])


def positions(rows: DataFrame, group: str, order: list[str], steps: Scratch) -> tuple[DataFrame, DataFrame]:
    """``rows`` in range partitions, and where each group starts in each of them.

    The second table is small: ``part, group, shift, size``, a row for each partition
    and each further group. See ``numbered``.
    """
    # a number for each row, so that many equal rows can be told apart
    told = rows.withColumn("tie", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in (group, *order, "tie")]
    placed = told.repartitionByRange(shuffle_partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    placed = steps.write(placed.drop("tie").withColumns({
        "part": F.spark_partition_id(), "at": F.monotonically_increasing_id()
    }), "placed")
    held = steps.write(
        placed.groupBy("part", group).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")), "parts"
    )
    # a group has a row for each partition here at most
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    starts = held.select("part", group, (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))
    return placed, starts


def numbered(placed: DataFrame, starts: DataFrame, group: str) -> DataFrame:
    """The rows with ``no``, from 0 within the group, and what else ``starts`` says of the group."""
    starts = starts.withColumnRenamed("part", "p").withColumnRenamed(group, "g")
    same = (F.col("part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g"))
    found = placed.join(starts, same).withColumn("no", F.col("at") + F.col("shift"))
    return found.drop("p", "g", "shift", "part", "at")


def siblings(nodes: Column, at: Column, fanout: int) -> Column:
    """The digests of the other nodes of the run of node ``at``, concatenated."""
    start = at - at % fanout
    run = F.slice(nodes, start + 1, fanout)
    others = F.filter(run, lambda _, i: i != at % fanout)
    return F.array_join(others, "")


def segments(leaves: DataFrame, fanout: int, steps: Scratch) -> tuple[DataFrame, DataFrame]:
    """Every node's segment to its parent, and each tree's root.

    ``leaves``: ``tree, no, size, hash`` and ``row``, a struct that stays with the leaf.
    Segments: ``tree, level, no, seg`` (binary) and ``row``, null above the leaves.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 at least")
    width = fanout ** LEVELS_AT_ONCE
    row_type = leaves.schema["row"].dataType.simpleString()
    base, level, parts, tops = leaves, 0, [], []
    while True:
        gathered = base.groupBy("tree", F.floor(F.col("no") / width).alias("run")).agg(
            F.sort_array(F.collect_list(F.struct("no", "hash", "row"))).alias("nodes"), F.first("size").alias("size")
        )

        def up(state: Column, _: Column) -> Column:
            below = F.element_at(state["levels"], -1)
            made = F.transform(
                F.sequence(F.lit(0), F.floor((F.size(below) - 1) / fanout).cast("int")),
                lambda j: F.sha2(F.array_join(F.slice(below, j * fanout + 1, fanout), ""), 256),
            )
            return F.when(
                state["size"] > 1,
                F.struct(F.concat(state["levels"], F.array(made)).alias("levels"),
                         F.ceil(state["size"] / fanout).cast("long").alias("size")),
            ).otherwise(state)

        start = F.struct(F.array(F.col("nodes.hash")).alias("levels"), F.col("size").alias("size"))
        built = gathered.select("tree", "run", "nodes", F.aggregate(
            F.sequence(F.lit(1), F.lit(LEVELS_AT_ONCE)), start, up
        ).alias("built"))
        built = steps.write(built.select("tree", "run", "nodes", "built.levels", "built.size"), "levels")
        # the last level of a run is the next round's lowest, unless the tree ends there
        kept = F.slice("levels", 1, F.when(F.col("size") == 1, F.size("levels")).otherwise(LEVELS_AT_ONCE))
        # arrays of small structs, so that exploding them copies nothing large
        each = F.flatten(F.transform(kept, lambda hashes, up: F.transform(hashes, lambda h, at: F.struct(
            up.alias("up"), at.alias("at"), F.unhex(siblings(hashes, at, fanout)).alias("seg"),
            F.when((up == 0) & F.lit(level == 0), F.get(F.col("nodes.row"), at)).alias("row"),
        ))))
        below = F.pow(F.lit(float(fanout)), LEVELS_AT_ONCE - F.col("node.up")).cast("long")
        parts.append(steps.write(built.select("tree", "run", F.explode(each).alias("node")).select(
            "tree", (F.col("node.up") + level).alias("level"), (F.col("run") * below + F.col("node.at")).alias("no"),
            "node.seg", "node.row",
        ), "segments"))
        top = F.element_at(F.element_at("levels", -1), 1)
        tops.append(steps.write(built.where("size = 1").select("tree", top.alias("hash")), "tops"))
        rest = built.where("size > 1").select(
            "tree", F.col("run").alias("no"), "size", top.alias("hash"), F.lit(None).cast(row_type).alias("row")
        )
        base = steps.write(rest, "base")
        steps.drop(built)
        level += LEVELS_AT_ONCE
        if base.isEmpty():
            break
    every, roots = parts[0], tops[0]
    for part, more in zip(parts[1:], tops[1:]):
        every, roots = every.unionByName(part), roots.unionByName(more)
    return every, roots


def proofs(nodes: DataFrame, fanout: int, steps: Scratch) -> DataFrame:
    """``tree, no, seg, row`` of the leaves, whose segments now reach their tree's root."""
    highest = nodes.agg(F.max("level")).first()[0] or 0
    held: DataFrame | None = None
    distance = 1
    while distance < highest:
        # pointers from the leaves land on multiples of the distance only
        lower = nodes.where(F.col("level") % (2 * distance) == 0)
        upper = nodes.where(F.col("level") % (2 * distance) == distance).select(
            F.col("tree").alias("t"), (F.col("level") - distance).alias("l"), F.col("no").alias("up"), F.col("seg").alias("more")
        )
        if upper.count() * (ROW_BYTES + distance * (fanout - 1) * HEX // 2) <= BROADCAST_BYTES:
            upper = F.broadcast(upper)
        above = F.floor(F.col("no") / F.lit(fanout ** distance)).cast("long") if fanout ** distance < 1 << 62 else F.lit(0)
        lands = (F.col("tree") == F.col("t")) & (F.col("level") == F.col("l")) & (above == F.col("up"))
        jumped = lower.join(upper, lands, "left").select(
            "tree", "level", "no", F.concat("seg", F.coalesce("more", F.unhex(F.lit("")))).alias("seg"), "row"
        )
        nodes = steps.write(jumped, "jumped")
        if held is not None:
            steps.drop(held)
        held = nodes
        distance *= 2
    return nodes.where("level = 0").drop("level")


def fold(own: Column, proof: Column, no: Column, size: Column, fanout: int = 2) -> Column:
    """The root that a leaf's digest and its proof (hex) lead to, for leaf ``no`` of ``size``."""
    start = F.struct(
        own.alias("h"), F.lit(1).alias("at"), no.cast("long").alias("no"), size.cast("long").alias("n"), proof.alias("proof")
    )

    def step(s: Column, _: Column) -> Column:
        place = s["no"] % fanout
        others = (F.least(F.lit(fanout).cast("long"), s["n"] - s["no"] + place) - 1).cast("int")
        left = F.substring(s["proof"], s["at"], (place * HEX).cast("int"))
        right = F.substring(s["proof"], s["at"] + (place * HEX).cast("int"), ((others - place) * HEX).cast("int"))
        return F.when(s["n"] > 1, F.struct(
            F.sha2(F.concat(left, s["h"], right), 256).alias("h"), (s["at"] + others * HEX).alias("at"),
            F.floor(s["no"] / fanout).cast("long").alias("no"), F.ceil(s["n"] / fanout).cast("long").alias("n"),
            s["proof"].alias("proof"),
        )).otherwise(s)

    return F.aggregate(F.sequence(F.lit(0), height(size, fanout)), start, step)["h"]


def height(size: Column, fanout: int) -> Column:
    """Levels above the leaves of a tree."""
    powers, at = [], 1
    while at < 1 << 62:
        powers.append(at)
        at *= fanout
    return sum((F.when(size > p, 1).otherwise(0) for p in powers[1:]), F.when(size > 1, 1).otherwise(0))


def manifest(
    rows: DataFrame, fields: list[str], key: str = "doc_id", group: str = "lang",
    changed: dict[str, Column] | None = None, fanout: int = 2,
) -> DataFrame:
    """The manifest of ``rows``: a row for each, with its proof from leaf to root.

    Returns ``key, group, no, size, leaf, subroot, root, group_no, groups, group_proof,
    proof, changed_leaf``; proofs are hex. ``changed``: other values of some fields, from
    which ``changed_leaf`` is taken (null where they are null: nothing changed).
    """
    steps = Scratch(rows.sparkSession)
    own = leaf([quoted(c) for c in fields])
    other = F.lit(None).cast("string")
    if changed:
        any_change = F.coalesce(*[c.isNotNull() for c in changed.values()])
        for c in changed.values():
            any_change = any_change | c.isNotNull()
        other = F.when(any_change, leaf([F.coalesce(changed[c], quoted(c).cast(_kind(rows, c))) if c in changed
                                         else quoted(c) for c in fields]))
    leaves = steps.write(rows.select(
        quoted(key).alias("key"), quoted(group).alias("group"), F.unhex(own).alias("leaf"), F.unhex(other).alias("changed"),
    ), "leaves")
    placed, starts = positions(leaves, "group", ["key", "leaf"], steps)
    starts = steps.write(starts, "starts")
    groups = steps.write(starts.groupBy("group").agg(F.first("size").alias("rows")).withColumn("all", F.lit(0)), "groups")
    ordered, first = positions(groups, "all", ["group"], steps)
    ranked = steps.write(numbered(ordered, first, "all").select(
        "group", "rows", F.col("no").alias("tree"), F.col("size").alias("groups")
    ), "ranked")

    named = starts.withColumnRenamed("group", "g")
    named = named.join(ranked.select("group", "tree"), F.col("group").eqNullSafe(F.col("g"))).drop("g")
    in_trees = numbered(placed, named, "group")
    nodes, subroots = segments(in_trees.select(
        "tree", "no", "size", _hex("leaf").alias("hash"), F.struct("key", "leaf", "changed").alias("row")
    ), fanout, steps)
    found = proofs(nodes, fanout, steps)

    tops = ranked.join(subroots, "tree").select(
        F.lit(0).alias("all"), F.col("tree").alias("no"), F.col("groups").alias("size"), "hash",
        F.struct("tree", "group", "rows", "hash").alias("row"),
    )
    top_nodes, root = segments(tops.withColumnRenamed("all", "tree"), fanout, steps)
    # the root is one row
    root = F.broadcast(root.select("tree", F.col("hash").alias("root")))
    top_proofs = proofs(top_nodes, fanout, steps).join(root, "tree")
    facts = steps.write(top_proofs.select(
        F.col("row.tree").alias("tree"), F.col("row.group").alias("group"), F.col("row.rows").alias("rows"),
        F.col("row.hash").alias("subroot"), "root", _hex("seg").alias("group_proof"),
    ).join(ranked.select("tree", "groups"), "tree"), "facts")
    total = leaves.count()
    return join_counted(found, facts, "tree", "rows", total).select(
        F.col("row.key").alias(key), F.col("group").alias(group), "no", F.col("rows").alias("size"),
        _hex("row.leaf").alias("leaf"), "subroot", "root", F.col("tree").alias("group_no"), "groups", "group_proof",
        _hex("seg").alias("proof"), _hex("row.changed").alias("changed_leaf"),
    )


def _hex(name: str) -> Column:
    return F.lower(F.hex(name))


def _kind(rows: DataFrame, name: str) -> str:
    """Whole numbers are widened, so that a changed one cannot overflow."""
    kind = rows.schema[name].dataType.simpleString()
    return "decimal(38,0)" if kind in ("tinyint", "smallint", "int", "bigint") else kind


def verified(made: DataFrame, fanout: int = 2) -> DataFrame:
    """The manifest with ``folded_root``, from the changed leaf if there is one, and ``verified``."""
    start = F.coalesce("changed_leaf", "leaf")
    subroot = fold(start, F.col("proof"), F.col("no"), F.col("size"), fanout)
    folded = made.withColumn("folded_root", subroot)
    folded = folded.withColumn(
        "folded_root", fold(F.col("folded_root"), F.col("group_proof"), F.col("group_no"), F.col("groups"), fanout)
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
