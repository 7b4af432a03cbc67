"""Merkle manifest of a dataset: a proof for every row that it belongs to one root.

A row is a leaf: the hash of its columns, each written as `-` if NULL, else as its
UTF-8 byte count, `:` and value.  Per group the leaves lie in order of the id (NULL
first, equal ids by leaf); every `fanout` neighbours become one node, level by
level, until one node is left, the group's subroot.  Subroots in order of the group
(NULL first) become the root in the same way.

A level is a slot pivot: conditional aggregates spread the children of a parent into
`fanout` columns, whose concatenation is hashed; the columns beside a child's own
are its siblings.  Positions come from range partitions, so a group of any size is
spread; parents group at most `fanout` rows.  Going down, each parent hands its
children the siblings of all levels above, once per parent and not per row.
Digests travel as 32 bytes and are hashed as lowercase hex text.

NULL columns are leaves as above, an empty text is `0:`.  Repeated rows are equal
leaves at neighbouring places, each with its own proof.  A lone leaf is its group's
subroot.  An empty table has no rows and no root.  Columns beside the named ones are
not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import held_out, stored
from chartloom.llm.graph import lookup
from chartloom.operators.ordering import add_position

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_STEPS = "array<struct<l:binary,r:binary>>"


def sized(c: Column) -> Column:
    """A value so that no two lists of values look alike."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[sized(c) for c in columns]), 256))


def shown(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def hashed(digests: Column) -> Column:
    """H of digests laid end to end."""
    return F.unhex(F.sha2(shown(digests), 256))


def _joined(columns: list[Column]) -> Column:
    """Digests of the children that are there, end to end."""
    empty = F.lit(b"")
    return F.concat(*[F.coalesce(c, empty) for c in columns]) if columns else empty


def group_key(c: Column) -> Column:
    """The group as text that is never NULL and sorts as the group does, NULL first."""
    return F.concat(F.when(c.isNull(), "0").otherwise("1"), F.coalesce(c.cast("string"), F.lit("")))


def _slots(fanout: int) -> list[str]:
    return [f"s{i}" for i in range(fanout)]


def pivoted(nodes: DataFrame, fanout: int, carry: Column | None = None) -> DataFrame:
    """(g, pos, n, s0.., node): the parents of nodes (g, pos, n, node), a level of whole groups."""
    slot = F.col("pos") % fanout
    spread = [F.max(F.when(slot == i, F.col("node"))).alias(f"s{i}") for i in range(fanout)]
    if carry is not None:
        spread.append(F.array_sort(F.collect_list(carry)).alias("children"))  # a parent has at most `fanout`
    above = nodes.groupBy("g", F.floor(F.col("pos") / fanout).alias("parent"), "n").agg(*spread)
    return above.select(
        "g",
        F.col("parent").alias("pos"),
        F.ceil(F.col("n") / fanout).cast("bigint").alias("n"),
        *[c for c in above.columns if c not in ("g", "parent", "n")],
        hashed(_joined([F.col(s) for s in _slots(fanout)])).alias("node"),
    )


def grown(nodes: DataFrame, fanout: int, carry: Column | None = None) -> tuple[list[DataFrame], DataFrame]:
    """Levels of parents, lowest first, and the (g, node) that remains of each group.

    nodes has g, pos from 0, n (nodes of the group) and node; carry is a value per
    node that the lowest parents keep in a list.
    """
    levels, roots = [], [nodes.filter("n = 1").select("g", "node")]
    while True:
        rest = nodes.filter("n > 1")
        if rest.isEmpty():
            break
        nodes = stored(pivoted(rest, fanout, None if levels else carry), "level")
        levels.append(nodes)
        roots.append(nodes.filter("n = 1").select("g", "node"))
    return levels, reduce(DataFrame.union, roots)


def _beside(fanout: int, i: int, prefix: str = "") -> Column:
    """Siblings of slot i, those before and those after it."""
    slots = [F.col(prefix + s) for s in _slots(fanout)]
    return F.struct(_joined(slots[:i]).alias("l"), _joined(slots[i + 1 :]).alias("r"))


def _children(level: DataFrame, paths: DataFrame, fanout: int) -> DataFrame:
    """(g, pos, path) of the children of a level, whose own paths are given."""
    at = F.struct("g", "pos")
    known = lookup(level.withColumn("at", at), paths.select(at.alias("at"), "path"), "at")
    kids = [
        F.when(
            F.col(f"s{i}").isNotNull(),
            F.struct(
                (F.col("pos") * fanout + i).alias("pos"), F.concat(F.array(_beside(fanout, i)), F.col("path")).alias("path")
            ),
        )
        for i in range(fanout)
    ]
    down = known.select("g", F.explode(F.filter(F.array(*kids), lambda k: k.isNotNull())).alias("k"))
    return down.select("g", "k.pos", "k.path")


def paths_down(levels: list[DataFrame], tops: DataFrame, fanout: int) -> list[DataFrame]:
    """Paths (g, pos, path) of the parents of each level; tops has (g, path) of what remains of the groups."""
    out: list[DataFrame] = []
    below = None
    for level in reversed(levels):
        last = lookup(level.filter("n = 1").select("g", "pos"), tops, "g")
        paths = last if below is None else last.unionByName(below)
        paths = stored(paths, "paths")
        out.append(paths)
        below = _children(level, paths, fanout)
    return out[::-1]


def _folded(leaf: Column, steps: Column) -> Column:
    return F.aggregate(steps, leaf, lambda node, s: hashed(F.concat(s["l"], node, s["r"])))


def _proof(steps: Column) -> Column:
    return hashed(F.aggregate(steps, F.lit(b""), lambda done, s: F.concat(done, s["l"], s["r"])))


def placed(leaves: DataFrame, order: str, ties: list[str]) -> tuple[DataFrame, DataFrame]:
    """leaves (with g) with pos from 0, and (g, n) of the groups."""
    at = stored(add_position(leaves, order, ["g"], into="pos", ties=ties).withColumn("pos", F.col("pos") - 1), "leaves")
    sizes = stored(at.groupBy("g").agg((F.max("pos") + 1).alias("n")), "sizes")
    return at, sizes


def proofs(
    docs: DataFrame,
    columns: list[str],
    ident: str,
    group: str,
    changed: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """(id, leaf, subroot, root, steps, proof, folded) of each row; digests as 32 bytes.

    steps are the siblings before and after the row's node, level by level up to the
    root.  folded is the root that they give with the leaf of the row in which
    `changed` replaces columns; without it, with the row's own leaf.
    """
    own = leaf_of([F.col(c) for c in columns])
    other = leaf_of([(changed or {}).get(c, F.col(c)) for c in columns])
    leaves = docs.select(F.col(ident).alias("id"), group_key(F.col(group)).alias("g"), own.alias("node"), other.alias("altered"))
    leaves = leaves.withColumn("altered", F.when(F.col("altered") != F.col("node"), F.col("altered")))
    at, sizes = placed(leaves, "id", ["node"])
    nodes = lookup(at, sizes, "g")
    row = F.struct((F.col("pos") % fanout).alias("slot"), "id", "altered")
    levels, subroots = grown(nodes, fanout, row)

    subroots = stored(subroots, "subroots")
    ranked = add_position(subroots.withColumnRenamed("g", "group"), "group", into="pos")
    top = ranked.select(F.lit("").alias("g"), "group", (F.col("pos") - 1).alias("pos"), "node", F.lit(subroots.count()).cast("bigint").alias("n"))
    top = stored(top, "top")
    top_levels, root = grown(top, fanout)
    start = root.select("g", F.array().cast(_STEPS).alias("path"))
    if top_levels:
        lowest = paths_down(top_levels, start, fanout)[0]
        ends = _children(top_levels[0], lowest, fanout)
    else:
        ends = start.select("g", F.lit(0).cast("bigint").alias("pos"), "path")
    found = root.first()
    whole = F.lit(bytes(found["node"]) if found else None).cast("binary")
    tops = lookup(top.withColumn("at", F.col("pos")), ends.select(F.col("pos").alias("at"), "path"), "at")
    tops = stored(tops.select(F.col("group").alias("g"), "path", F.col("node").alias("subroot")), "tops")

    lone = lookup(nodes.filter("n = 1"), tops, "g").select("id", F.col("node").alias("leaf"), "altered", "subroot", F.col("path").alias("steps"))
    if not levels:
        rows = lone
    else:
        path = paths_down(levels, tops.select("g", "path"), fanout)[0]
        at = F.struct("g", "pos")
        parents = lookup(levels[0].withColumn("at", at), path.select(at.alias("at"), "path"), "at")
        parents = lookup(parents, tops.select("g", "subroot"), "g")
        kids = [
            F.struct(F.get("children", F.lit(i)).alias("c"), F.col(f"s{i}").alias("leaf"), _beside(fanout, i).alias("beside"))
            for i in range(fanout)
        ]
        each = parents.select("subroot", "path", F.explode(F.filter(F.array(*kids), lambda k: k["leaf"].isNotNull())).alias("k"))
        many = each.select(
            F.col("k.c.id").alias("id"),
            F.col("k.leaf").alias("leaf"),
            F.col("k.c.altered").alias("altered"),
            "subroot",
            F.concat(F.array("k.beside"), "path").alias("steps"),
        )
        rows = many.union(lone)
    return rows.select(
        "id",
        "leaf",
        "subroot",
        whole.alias("root"),
        "steps",
        _proof(F.col("steps")).alias("proof"),
        _folded(F.coalesce("altered", "leaf"), F.col("steps")).alias("folded"),
    )


def manifest(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Proofs of documents as hex text, every fifth document checked with a lower-cased text."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(held_out("doc_id"), low).otherwise(F.col("text"))
    out = proofs(docs.select(*COLUMNS), list(COLUMNS), "doc_id", "source", {"text": tampered}, fanout)
    return out.select(
        F.col("id").alias("doc_id"),
        *[shown(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        shown(F.col("proof")).alias("proof_sha256"),
        shown(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
