"""Merkle manifest of a dataset, with an octopus multiproof for each partition of its leaves.

A row's leaf is a digest of its fields. The leaves of a source, in order of id, are
the bottom of a tree whose nodes are digests of `ARITY` neighbours, the last of a
level of what is left over; the roots of all sources, in order, are the bottom of one
more tree, whose root stands for the dataset. A level of one node ends a tree.

Leaves are dealt into ranges of that order, so a source of any size lies in as many
partitions as it fills. Blocks of `ARITY ** BLOCK_LEVELS` neighbours become nodes in
one task, and their tops the bottom of the next round. For its proofs a leaf partition
names the coordinates (tree, level, place) of the nodes that its own leaves do not
give: at each level the siblings of what it knows, the octopus. These are looked up
once for the whole partition; the inner nodes that its leaves share are derived anew,
and each leaf's proof is expanded from both.

A null field is `-`. Rows of one source and id are leaves in order of their digests, a
null id comes first and is never tampered with, and copies of a row are leaves of their
own. A lone leaf is its source's root, a lone source's root that of the dataset, and an
empty table gives no rows. Columns that are not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.common import dealt, stored

ARITY = 3
BLOCK_LEVELS = 6
# Leaves that share one multiproof, or so.
PARTITION_LEAVES = 8192
# Bytes of a node's row, or a leaf's, in a task, or so.
NODE_ROW = 256

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# The tree of the sources' roots stands beside those of the sources.
_SOURCE, _TOP = 0, 1


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each with its length in bytes, so no two rows read alike."""
    marked = []
    for field in fields:
        value = field.cast("string")
        marked.append(F.coalesce(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")
        ))
    return F.sha2(F.concat(*marked).cast("binary"), 256)


# ---- order -----------------------------------------------------------------------


def placed(
    rows: DataFrame, tree: str, order: Sequence[str], each: int = PARTITION_LEAVES
) -> DataFrame:
    """`rows` with `part`, the range they lie in, `at`, their place in their tree, and its size `n`.

    Rows are counted in each range and tree; what a tree has in earlier ranges comes from these
    counts alone, so no task ever holds more than a range. Copies of a row are told apart by a
    number that is stored with them, so that any number of them can lie in several ranges.
    """
    kept = stored(rows.withColumn("copy", F.monotonically_increasing_id()), "to-place")
    ranges = kept.count() // each + 1
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order, "copy")]
    dealt = kept.repartitionByRange(ranges, *keys).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "ranges")
    of_tree = Window.partitionBy(tree)
    earlier = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = dealt.groupBy("part", tree).agg(F.count("*").alias("rows"))
    counted = stored(
        counted.select(
            F.col("part").alias("p"), F.col(tree).alias("t"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
            F.sum("rows").over(of_tree).alias("n"),
        ), "stretches",
    )
    here = F.row_number().over(Window.partitionBy("part", tree).orderBy(*keys[1:]))
    numbered = dealt.withColumn("row", here)
    same = (F.col("part") == F.col("p")) & F.col(tree).eqNullSafe(F.col("t"))
    found = numbered.join(counted, same)
    return found.withColumn("at", F.col("before") + F.col("row") - 1).drop(
        "row", "before", "p", "t", "copy"
    )


# ---- trees -----------------------------------------------------------------------


def _above(size: int) -> int:
    return -(-size // ARITY)


def levels(nodes: list[str], size: int, most: int) -> Iterator[tuple[int, list[str]]]:
    """(size of the whole level, its nodes here) of each level above a block's, `most` at most."""
    while size > 1 and most:
        nodes = [digest(nodes[i:i + ARITY]) for i in range(0, len(nodes), ARITY)]
        size, most = _above(size), most - 1
        yield size, nodes


_NODE = "kind int, source string, level int, at bigint, n bigint, node string"


def _builder(start: int, block_levels: int) -> Callable[[pa.Table], pa.Table]:
    """The nodes above one block of neighbours that lie on level `start`."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        kind, source = table.column("kind")[0].as_py(), table.column("source")[0].as_py()
        first, size = table.column("at")[0].as_py(), table.column("n")[0].as_py()
        rows = []
        built = levels(table.column("node").to_pylist(), size, block_levels)
        for up, (size, found) in enumerate(built, 1):
            first //= ARITY
            rows += [(start + up, first + i, size, node) for i, node in enumerate(found)]
        level, at, n, node = zip(*rows)
        return pa.table({
            "kind": pa.array([kind] * len(rows), pa.int32()),
            "source": pa.array([source] * len(rows), pa.string()),
            "level": pa.array(level, pa.int32()), "at": pa.array(at, pa.int64()),
            "n": pa.array(n, pa.int64()), "node": pa.array(node, pa.string()),
        })

    return build


def grow(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """All nodes of the trees whose bottoms are `leaves` (kind, source, at, n, node), stored."""
    rows = leaves.count()
    width = ARITY ** block_levels
    bottom = leaves.select("kind", "source", F.lit(0).alias("level"), "at", "n", "node")
    nodes = bottom
    start = 0
    while True:
        block = F.floor(F.col("at") / F.lit(width))
        blocks = bottom.where("n > 1").withColumn("block", block)
        grouped = dealt(blocks, rows * NODE_ROW, "kind", "source", "block").groupBy(
            "kind", "source", "block"
        )
        built = stored(grouped.applyInArrow(_builder(start, block_levels), _NODE), f"nodes-above-{start}")
        nodes = nodes.unionByName(built)
        start += block_levels
        bottom = built.where((F.col("level") == start) & (F.col("n") > 1))
        rows = bottom.count()
        if not rows:
            return nodes


# ---- proofs ----------------------------------------------------------------------


def octopus(known: Iterable[int], size: int) -> Iterator[tuple[int, int]]:
    """(level, place) of the nodes that, beside the `known` leaves, lead to the root: no others."""
    level, here = 0, sorted(set(known))
    while size > 1:
        held, parents = set(here), sorted({i // ARITY for i in here})
        for parent in parents:
            for i in range(parent * ARITY, min((parent + 1) * ARITY, size)):
                if i not in held:
                    yield level, i
        here, size, level = parents, _above(size), level + 1


class Partial:
    """As much of one tree as the leaves of a partition and its multiproof give."""

    def __init__(self, size: int, leaves: dict[int, str], fetched: dict[tuple[int, int], str]):
        self.sizes = [size]
        while self.sizes[-1] > 1:
            self.sizes.append(_above(self.sizes[-1]))
        self.levels: list[dict[int, str]] = [{} for _ in self.sizes]
        for (level, i), node in fetched.items():
            self.levels[level][i] = node
        here = dict(leaves)
        for level, size in enumerate(self.sizes):
            self.levels[level].update(here)
            if size > 1:
                parents = {i // ARITY for i in here}
                here = {p: digest(self.family(level, p)) for p in parents}
        self.root = self.levels[-1][0]
        # The siblings on the way from a node to the root, from that node's parent on.
        self._paths: dict[tuple[int, int], list[str]] = {(len(self.sizes) - 1, 0): []}

    def family(self, level: int, parent: int) -> list[str]:
        last = min((parent + 1) * ARITY, self.sizes[level])
        return [self.levels[level][i] for i in range(parent * ARITY, last)]

    def path(self, level: int, i: int) -> list[str]:
        """The siblings of a node and of those above it, level by level, left to right."""
        if (level, i) not in self._paths:
            family = self.family(level, i // ARITY)
            del family[i % ARITY]
            found = family + self.path(level + 1, i // ARITY)
            if not level:
                return found
            self._paths[level, i] = found
        return self._paths[level, i]

    def fold(self, i: int, node: str) -> str:
        """The root if leaf `i` were `node`."""
        for level in range(len(self.sizes) - 1):
            family = self.family(level, i // ARITY)
            family[i % ARITY] = node
            node, i = digest(family), i // ARITY
        return node


class Stretch(NamedTuple):
    """A source's leaves in one partition, and where its root stands among all sources'."""

    first: int
    leaves: int
    size: int
    place: int
    sources: int


_NEED = "part int, kind int, source string, level int, at bigint"


def _missing(table: pa.Table) -> pa.Table:
    """The octopus of one leaf partition, from its stretches."""
    rows, places, sources = [], [], 0
    part = table.column("part")[0].as_py()
    for row in table.to_pylist():
        leaves = range(row["first"], row["first"] + row["leaves"])
        rows += [(_SOURCE, row["source"], *spot) for spot in octopus(leaves, row["size"])]
        places.append(row["place"])
        sources = row["sources"]
    rows += [(_TOP, None, *spot) for spot in octopus(places, sources)]
    kind, source, level, at = zip(*rows) if rows else ((), (), (), ())
    return pa.table({
        "part": pa.array([part] * len(rows), pa.int32()), "kind": pa.array(kind, pa.int32()),
        "source": pa.array(source, pa.string()), "level": pa.array(level, pa.int32()),
        "at": pa.array(at, pa.int64()),
    })


_PROOF = (
    "doc_id bigint, source string, leaf string, held string, subroot string, root string, "
    "proof array<string>, folded_root string"
)


def _expand(leaves: pa.Table, given: pa.Table) -> pa.Table:
    """Each leaf's proof, and the root that its row as held now leads to."""
    stretches: dict[str | None, Stretch] = {}
    fetched: dict[tuple[int, str | None], dict[tuple[int, int], str]] = {}
    for row in given.to_pylist():
        if row["kind"] is None:
            stretches[row["source"]] = Stretch(*(row[name] for name in Stretch._fields))
        else:
            tree = fetched.setdefault((row["kind"], row["source"]), {})
            tree[row["level"], row["at"]] = row["node"]
    at, sources = leaves.column("at").to_pylist(), leaves.column("source").to_pylist()
    nodes, held = leaves.column("leaf").to_pylist(), leaves.column("held").to_pylist()
    bottoms: dict[str | None, dict[int, str]] = {source: {} for source in stretches}
    for source, i, node in zip(sources, at, nodes):
        bottoms[source][i] = node
    trees = {
        source: Partial(stretches[source].size, bottom, fetched.get((_SOURCE, source), {}))
        for source, bottom in bottoms.items()
    }
    places = {stretches[source].place: tree.root for source, tree in trees.items()}
    top = Partial(next(iter(stretches.values())).sources, places, fetched.get((_TOP, None), {}))
    proofs, folded = [], []
    for source, i, node, now in zip(sources, at, nodes, held):
        tree, place = trees[source], stretches[source].place
        proofs.append(tree.path(0, i) + top.path(0, place))
        folded.append(top.fold(place, tree.fold(i, now or node)))
    return pa.table({
        "doc_id": leaves.column("id"), "source": leaves.column("source"),
        "leaf": leaves.column("leaf"), "held": leaves.column("held"),
        "subroot": pa.array([trees[s].root for s in sources], pa.string()),
        "root": pa.array([top.root] * len(nodes), pa.string()),
        "proof": pa.array(proofs, pa.list_(pa.string())), "folded_root": pa.array(folded, pa.string()),
    })


def manifest(
    rows: DataFrame, held: Column | None = None, id_column: str = "doc_id",
    source_column: str = "source", fields: Sequence[str] = FIELDS,
    partition_leaves: int = PARTITION_LEAVES, block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """A row per row: its leaf, its source's root, the dataset's root and its `proof`, the
    siblings from its leaf to the root.

    `held` is the leaf of the row as somebody has it now; `folded_root` is where that and the
    proof lead, which is `root` if nothing was changed.
    """
    leaf = leaf_digest(*[F.col(f"`{name}`") for name in fields])
    digests = rows.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.col(f"`{source_column}`").cast("string").alias("source"),
        leaf.alias("leaf"), (leaf if held is None else held).alias("held"),
    ).withColumn("held", F.when(F.col("held") != F.col("leaf"), F.col("held")))
    leaves = stored(placed(digests, "source", ["id", "leaf"], partition_leaves), "leaves")
    bottoms = leaves.select(F.lit(_SOURCE).alias("kind"), "source", "at", "n", F.col("leaf").alias("node"))
    nodes = grow(bottoms, block_levels)

    roots = nodes.where("n = 1").select(F.lit(None).cast("string").alias("all"), "source", "node")
    tops = stored(
        placed(roots, "all", ["source"], partition_leaves)
        .select("source", "at", "n", "node"), "roots",
    )
    above = grow(
        tops.select(F.lit(_TOP).alias("kind"), F.lit(None).cast("string").alias("source"), "at", "n", "node"),
        block_levels,
    )

    here = leaves.groupBy("part", "source").agg(
        F.min("at").alias("first"), F.count("*").alias("leaves"), F.first("n").alias("size"),
    )
    known = tops.select(F.col("source").alias("of"), F.col("at").alias("place"), F.col("n").alias("sources"))
    stretches = stored(
        here.join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "leaf-stretches"
    )
    needed = stored(stretches.groupBy("part").applyInArrow(_missing, _NEED), "missing-nodes")
    spots = needed.select("part", *[F.col(c).alias(f"of_{c}") for c in ("kind", "source", "level", "at")])
    every = nodes.unionByName(above)
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ("kind", "source", "level", "at")]
    found = every.join(spots, same).select("part", "kind", "source", "level", "at", "node")
    given = stored(found.unionByName(stretches, allowMissingColumns=True), "multiproofs")
    total = leaves.count() * NODE_ROW
    proved = (
        dealt(leaves, total, "part").groupBy("part")
        .cogroup(dealt(given, total, "part").groupBy("part")).applyInArrow(_expand, _PROOF)
    )
    return proved.withColumnRenamed("doc_id", id_column)
