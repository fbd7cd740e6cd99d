"""Merkle manifest of a table, by self-joins of siblings.

Every row is a leaf: the digest of its columns. The leaves of a group, in order, are merged in
runs of ``arity`` until one digest, the group's subroot, is left; the subroots, in the order of
their groups, are merged the same way into one root. A proof holds the siblings on a leaf's way
to the root: whoever has a row, its proof and the root can tell whether the row was changed.

A node is (tree, place). Its siblings' places follow from its own: XOR with 1 in a binary tree,
else offsets of its slot in the run. So each level is an equi-join of the nodes with themselves
on computed places, unique keys that deal out evenly however large a group is. The node of slot
zero then holds its whole run and emits the parent. Levels are written to the shared folder:
half as many nodes as there are rows, over all levels above the leaves. On the way down each
level's nodes join their parents and put their own siblings before the parents' proofs.

Places come from a range partitioning of all rows by group and order: a row's place is its
position in its partition plus what partitions before it hold of its group, so no group is
ever sorted in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Spark numbers rows by partition in the high bits and by position in the low 33.
_LOW = 33


def _none() -> Column:
    return F.lit(b"")


def text_digest(text: Column) -> Column:
    """SHA-256 of a text, as its 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def as_text(digests: Column) -> Column:
    """One or more digests as lower-case hex text."""
    return F.lower(F.hex(digests))


def digest(*digests: Column) -> Column:
    """The digest over other digests' hex texts."""
    return text_digest(as_text(F.concat(*digests)))


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value: no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return text_digest(F.concat(*map(field, values)))


def _dealt(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows in order over partitions, and what each partition holds of each group.

    Nulls come first, strings by their bytes. Rows that tie in everything may stand in any
    order among each other, and are dealt over several partitions if they are many.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    salt = F.xxhash64(F.monotonically_increasing_id())
    dealt = rows.withColumn("salt", salt).repartitionByRange(*keys, "salt").sortWithinPartitions(*keys)
    # the numbers are taken after the sort, and written, so that they hold from here on
    dealt = stored(dealt.drop("salt").withColumn("at", F.monotonically_increasing_id()), "ordered")
    dealt = dealt.withColumns({"part": F.shiftright("at", _LOW), "at": F.col("at").bitwiseAND((1 << _LOW) - 1)})
    parts = dealt.groupBy(group, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    whole = Window.partitionBy(group)
    before = F.sum("held").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return dealt, stored(
        parts.select(
            F.col(group).alias("group"), F.col("part").alias("of"),
            (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("held").over(whole).alias("n"),
        ),
        "parts",
    )


def _placed(dealt: DataFrame, parts: DataFrame, group: str) -> DataFrame:
    """The rows with ``i``, their place in their group from 0 on, and what else ``parts`` has."""
    placed = dealt.join(parts, F.col(group).eqNullSafe(F.col("group")) & (F.col("part") == F.col("of")))
    return placed.withColumn("i", F.col("at") + F.col("shift")).drop("group", "of", "shift", "at", "part")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (tree, i, h, ...) with the digests of the siblings ``before`` and ``after`` them."""
    slot = F.pmod("i", F.lit(arity))
    out, before, after = nodes, [], []
    for step in range(1, arity):
        place = F.col("i").bitwiseXOR(1) if arity == 2 else F.col("i") - slot + F.pmod(slot + step, F.lit(arity))
        other = nodes.select("tree", F.col("i").alias("key"), F.col("h").alias(f"h{step}"))
        out = out.withColumn("key", place).join(other, ["tree", "key"], "left").drop("key")
        # past the run's end the steps go on at its begin, with slots that rise again
        past, found = slot + step >= arity, F.col(f"h{step}")
        before.append(F.coalesce(F.when(past, found), _none()))
        after.append(F.coalesce(F.when(~past, found), _none()))
    return out.select(*nodes.columns, F.concat(*before).alias("before"), F.concat(*after).alias("after"))


def _levels(leaves: DataFrame, arity: int, name: str) -> list[DataFrame]:
    """The stored levels of all trees, leaves (tree, i, n, h, ...) first.

    ``n`` is the number of a tree's nodes on the level; a tree ends where that is 1.
    """
    levels, nodes = [], leaves
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(stored(with_siblings(nodes, arity), name))
        heads = levels[-1].where((F.pmod("i", F.lit(arity)) == 0) & (F.col("n") > 1))
        nodes = heads.select("tree", F.expr(f"i div {arity}").alias("i"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), digest(F.col("h"), F.col("after")).alias("h"))
        most = -(-most // arity)
    alone = nodes.withColumns({"before": _none(), "after": _none()})
    return [*levels, stored(alone, name)]


def _ends(levels: list[DataFrame]) -> DataFrame:
    """(tree, h, level) of each tree's last node."""
    out = None
    for k, level in enumerate(levels):
        some = level.where("n = 1").select("tree", "h", F.lit(k).alias("level"))
        out = some if out is None else out.union(some)
    return out


_PATH = "array<struct<before: binary, after: binary>>"


def _proofs(levels: list[DataFrame], ends: DataFrame, arity: int) -> DataFrame:
    """The leaves with ``path``, the siblings at each level up, and the columns of ``ends``.

    ``ends`` has (tree, level, path, ...) of each tree's last node: what follows above it.
    """
    carried = [c for c in ends.columns if c not in ("tree", "level", "path")]
    known = None
    for k in reversed(range(len(levels))):
        level = levels[k].drop("h") if k else levels[k]
        last = level.where("n = 1").join(ends.where(F.col("level") == k).drop("level"), "tree")
        here = last.select(*level.columns, "path", *carried)
        if known is not None:
            up = known.select("tree", F.col("i").alias("up"), "path", *carried)
            below = level.where("n > 1").withColumn("up", F.expr(f"i div {arity}")).join(up, ["tree", "up"])
            step = F.array(F.struct("before", "after"))
            here = here.union(below.select(*level.columns, F.concat(step, "path").alias("path"), *carried))
        known = here
    return known


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, start, lambda now, step: digest(step["before"], now, step["after"]))


def siblings(path: Column) -> Column:
    """All digests of a proof in their order, one after the other."""
    return F.aggregate(path, _none(), lambda now, step: F.concat(now, step["before"], step["after"]))


def manifest(
    rows: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "source",
    order: str = "doc_id", arity: int = 3, found: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(order column, group column, ``leaf``, ``subroot``, ``root``, ``path``, ``folded_root``, ``verified``) of every row.

    Digests are lower-case hex text, but for ``path``: the proof, with the digests ``before``
    and ``after`` the row's node as bytes, from the leaf's run to that below the root.
    ``found`` gives columns as they were found later; ``folded_root`` is recomputed from the
    row as found, and ``verified`` tells whether it is the root.

    Nulls in any column are values of their own; a null group is a group, before all others, and a
    null order stands first in its group. Rows of equal order stand in the order of their
    digests; repeated rows are leaves each. A lone row is its group's subroot, a lone subroot the root.
    Other columns are left out, whatever their names. An empty table gives no rows.
    """
    if arity < 2:
        raise ValueError("a run has two nodes or more")
    found = found or {}
    hashed = rows.select(
        F.col(order).alias("order"), F.col(group).alias("group_"), leaf([F.col(c) for c in columns]).alias("h"),
        leaf([found.get(c, F.col(c)) for c in columns]).alias("found"),
    )
    # texts are read here only
    dealt, parts = _dealt(stored(hashed, "leaves"), "group_", ["order", "h"])
    groups = stored(parts.select(F.col("group").alias("name"), F.lit(0).alias("all")).distinct(), "groups")
    trees = _placed(*_dealt(groups, "all", ["name"]), "all").select("name", F.col("i").alias("tree"), F.col("n").alias("trees"))
    trees = stored(trees, "trees")
    # a group is named in its parts, not in its rows, so none of its rows meet by group
    parts = parts.join(trees.select("name", "tree"), F.col("group").eqNullSafe(F.col("name"))).drop("name")
    named = stored(_placed(dealt, parts, "group_"), "placed")
    levels = _levels(named, arity, "level")
    ends = stored(_ends(levels), "subroots")

    top = ends.join(trees.select("tree", "trees"), "tree").select(F.lit(0).alias("tree"), F.col("tree").alias("i"), F.col("trees").alias("n"), "h", F.col("level").alias("below"))
    tops = _levels(top, arity, "top")
    root = _ends(tops).select("tree", F.lit(len(tops) - 1).alias("level"), F.lit(None).cast(_PATH).alias("path"), F.col("h").alias("root"))
    root = root.withColumn("path", F.array().cast(_PATH))
    above = _proofs(tops, root, arity).select(F.col("i").alias("tree"), F.col("below").alias("level"), "path", F.col("h").alias("subroot"), "root")
    proven = _proofs(levels, stored(above, "above"), arity)
    return proven.select(
        F.col("order").alias(order), F.col("group_").alias(group), as_text(F.col("h")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"),
        as_text(F.col("root")).alias("root"), "path", as_text(folded(F.col("found"), F.col("path"))).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
