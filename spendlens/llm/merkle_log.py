"""Merkle manifest of a dataset: a postorder append log for each source, proofs by closed-form positions.

Every row is a leaf; the leaves of a source, ordered by id, are hashed in runs of 16 until one node, the
source's subroot, is left, and the subroots, ordered by source, likewise to the root.

1. *Order.* Leaf digests (built-in functions, one scan of the table) are range-partitioned by
   source and id; a leaf's index is its place in its partition plus what earlier partitions hold
   of its source. No source is gathered: one that holds a third of all rows is many partitions.
2. *Append log.* An aligned builder takes ``FAN ** HEIGHT`` = 256 neighbouring nodes of a tree and writes
   them and the nodes above them in order of completion, that is in postorder. What a builder ends
   with is a node of the next pass, so a tree of n leaves takes some log(n) / log(256) passes.
   A node's position in its source's log follows from the sizes of complete subtrees alone: of node
   (level, index) with last leaf e it is ``level + e + e // 16 + e // 256 + ...`` (whole subtrees are
   logged before it; the last, ragged nodes complete after the last leaf), so builders need not
   know of each other.
3. *Proofs.* A node's siblings are read from its builder's part of the log, at positions computed from
   their level and index. The part's top node brings its own path, found in the pass above, which
   has one row for 256.

Scale: texts are read once and never shuffled. A task holds a few builders' parts of at most 273 nodes;
the number of sources is not bounded (they are counted and ordered as leaves are). Passes are written to
the shared folder. Only the root reaches the driver.

Defined results: a null field is hashed as ``-``; a null source is a source of its own, the first; a null
id comes first in its source; rows that share an id are ordered by digest, equal rows are leaves of their
own; an empty text is ``0:``; very long texts are hashed whole; an empty table has no nodes and no root;
only the hashed columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .common import bounded_batches, whole_runs

FAN = 16
#: levels of nodes that one builder puts on its own
HEIGHT = 2
#: rows a task takes at once
_ROWS = 4_096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = ("tree", "size", "level", "index", "position", "digest")
_NODE_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
_PATH = "array<struct<at:int,others:array<string>>>"
_PATH_TYPE = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.string()))]))


def field(value: Column) -> Column:
    """What is hashed of a value: ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


def digest_of(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a tree of ``size`` leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def width(level: int, size: int) -> int:
    """Nodes of a level."""
    return -(-size // FAN**level)


def position(level: int, index: int, size: int) -> int:
    """Place of a node in its tree's postorder log."""
    last = min((index + 1) * FAN**level, size) - 1
    place = level + last
    while last := last // FAN:
        place += last
    return place


def top_position(size: str) -> str:
    """SQL of the position of a tree's top: the last leaf's, and one more for each level of the tree."""
    last = f"({size} - 1)"
    levels = [f"shiftright({last}, {4 * k}) + CAST({size} > {FAN**k} AS BIGINT)" for k in range(16)]
    return " + ".join(levels)


def siblings(level: int, index: int, size: int) -> range:
    """Indexes of a node's run, itself included."""
    first = index - index % FAN
    return range(first, min(first + FAN, width(level, size)))


def fold(digest: str, path: Sequence[dict]) -> str:
    """The root that a leaf's digest and its path give."""
    for step in path:
        digest = digest_of([*step["others"][: step["at"]], digest, *step["others"][step["at"] :]])
    return digest


def build(leaves: Sequence[str], size: int, base: int, first: int) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) in order of completion, of one builder's nodes.

    ``leaves`` are the digests of the nodes of level ``base`` from index ``first`` on, ``size`` is the number
    of leaves of the whole tree; a builder stops ``HEIGHT`` levels above ``base`` or at the tree's top.
    """
    top = min(base + HEIGHT, height(size))
    open_runs: list[list[str]] = [[] for _ in range(HEIGHT)]
    for i, digest in enumerate(leaves, first):
        level, index = base, i
        yield level, index, digest
        while level < top:
            run = open_runs[level - base]
            run.append(digest)
            if len(run) < FAN and index + 1 < width(level, size):
                break
            digest, level, index = digest_of(run), level + 1, index // FAN
            run.clear()
            yield level, index, digest


def _parts(rows: pa.Table, starts: np.ndarray, names: Sequence[str]) -> Iterator[tuple[int, dict[str, list]]]:
    """(first row, columns) of each builder's part."""
    for a, z in zip(starts.tolist(), [*starts[1:].tolist(), rows.num_rows]):
        yield a, rows.select(names).slice(a, z - a).to_pydict()


def _built(base, batches):
    """Nodes of level ``base``, ordered within blocks, to the builders' parts of the log."""
    for rows, starts in whole_runs(batches, "tree", "block", least=_ROWS):
        out, of = {k: [] for k in _NODE}, []
        for a, b in _parts(rows, starts, ("tree", "size", "index", "digest")):
            tree, size, first = b["tree"][0], b["size"][0], b["index"][0]
            for level, index, digest in build(b["digest"], size, base, first):
                for column, v in zip(out.values(), (tree, size, level, index, position(level, index, size), digest)):
                    column.append(v)
                of.append(a + index - first if level == base else None)
        carried = rows.column("carried").combine_chunks().take(pa.array(of, pa.int64()))
        arrays = [*(pa.array(v, k) for v, k in zip(out.values(), _NODE_TYPES)), carried]
        yield from pa.table(arrays, names=[*_NODE, "carried"]).to_batches()


def append_log(leaves: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """The log of every tree of ``leaves`` (tree, size, index, digest, carried), as one relation a pass:
    (tree, size, level, index, position, digest, carried). A pass has the nodes it starts from and those above."""
    passes, base = [], 0
    nodes = leaves
    kinds = "tree bigint, size bigint, level int, index bigint, position bigint, digest string, carried "
    kinds += leaves.schema["carried"].dataType.simpleString()
    while not passes or not nodes.isEmpty():
        blocked = nodes.select("tree", F.shiftright("index", 4 * HEIGHT).alias("block"), "size", "index", "digest", "carried")
        blocked = blocked.repartition("tree", "block").sortWithinPartitions("tree", "block", "index")
        passes.append(scratch.write(blocked.mapInArrow(partial(_built, base), kinds), f"{name}-{len(passes)}"))
        base += HEIGHT
        # a tree goes on while its last pass left more nodes than one
        nodes = passes[-1].where((F.col("level") == base) & (F.col("size") > FAN**base))
    return passes


def tops(passes: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the trees' top nodes."""
    found = None
    for n, log in enumerate(passes):
        own = log.where(_ends(n)).select("tree", "digest")
        found = own if found is None else found.union(own)
    return found


def _ends(n: int) -> str:
    """SQL of whether a node of pass ``n`` is its tree's top, and the pass the one that reached it."""
    begun = f"size > {FAN ** (n * HEIGHT)} AND " if n else ""
    return f"{begun}size <= {FAN ** ((n + 1) * HEIGHT)} AND position = {top_position('size')}"


def _paths(base, folded, batches):
    """Of each node of level ``base``: its place in its run and the others' digests, level by level
    up to the tree's top, then what its part's top node brings. If ``folded``, only the digest of all
    the others, and what the checked digest and they give at the top."""
    names = ["size", "level", "index", "position", "digest", "above", *(["checked"] if folded else [])]
    for rows, starts in whole_runs(batches, "tree", "block", least=_ROWS):
        of, out = [], ([], [])
        for a, b in _parts(rows, starts, names):
            size, log = b["size"][0], dict(zip(b["position"], b["digest"]))
            top = min(base + HEIGHT, height(size))
            above = b["above"][-1] or []  # the part's last node is its top
            runs: dict[tuple[int, int], list[str]] = {}
            for i, (level, index) in enumerate(zip(b["level"], b["index"])):
                if level != base:
                    continue
                path = []
                for up in range(base, top):
                    node = index // FAN ** (up - base)
                    own, at = siblings(up, node, size), node % FAN
                    if (run := runs.get((up, own.start))) is None:
                        run = runs[up, own.start] = [log[position(up, k, size)] for k in own]
                    path.append({"at": at, "others": run[:at] + run[at + 1 :]})
                path += above
                of.append(a + i)
                if folded:
                    out[0].append(digest_of([x for step in path for x in step["others"]]))
                    out[1].append(fold(b["checked"][i], path))
                else:
                    out[0].append(path)
        take = pa.array(of, pa.int64())
        if folded:
            added = {"proof_sha256": pa.array(out[0], pa.string()), "folded_root": pa.array(out[1], pa.string())}
        else:
            added = {"path": pa.array(out[0], _PATH_TYPE)}
        kept = {k: rows.column(k).combine_chunks().take(take) for k in ("tree", "index", "digest", "carried")}
        yield from pa.table(kept | added).to_batches(max_chunksize=1_000)


def paths(passes: list[DataFrame], top: DataFrame | None = None, checked: str | None = None) -> DataFrame:
    """(tree, index, digest, carried, path) of the leaves of a log. ``top`` (tree, path) is what the trees' own
    tops have above them. If ``checked`` names a digest among the carried fields, proof_sha256 and
    folded_root take the path's place."""
    above = None
    for n in range(len(passes) - 1, -1, -1):
        base = n * HEIGHT
        block = F.expr(f"shiftright(index, 4 * ({base + HEIGHT} - level))").alias("block")
        log = passes[n].select("tree", block, "size", "level", "index", "position", "digest", "carried")
        # what a part's top node has above it: known from the pass above, or given for the tree's own top
        known = []
        if above is not None:
            known.append(above.select("tree", F.lit(base + HEIGHT).alias("level"), "index", F.col("path").alias("above")))
        if top is not None:
            known.append(passes[n].where(_ends(n)).join(top, "tree").select("tree", "level", "index", F.col("path").alias("above")))
        if known:
            log = log.join(known[0] if len(known) == 1 else known[0].union(known[1]), ["tree", "level", "index"], "left")
        else:
            log = log.withColumn("above", F.lit(None).cast(_PATH))
        folded = checked is not None and not n
        if folded:
            log = log.withColumn("checked", F.col("carried").getField(checked))
        carried = passes[n].schema["carried"].dataType.simpleString()
        given = "proof_sha256 string, folded_root string" if folded else f"path {_PATH}"
        above = (
            log.repartition("tree", "block")
            .sortWithinPartitions("tree", "block", "position")
            .mapInArrow(partial(_paths, base, folded), f"tree bigint, index bigint, digest string, carried {carried}, {given}")
        )
    return above


def indexed(rows: DataFrame, scratch: Scratch, name: str, tree: str, *order: str) -> DataFrame:
    """``rows`` with ``index``, their place by ``order`` among those of one ``tree`` (not null), and the tree's
    ``size``."""
    # rows of a range partition, numbered: the partition in the upper bits, the place in the lower 33
    sorted_rows = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    rows = scratch.write(sorted_rows.withColumn("_n", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("_part", F.shiftright("_n", 33))
    counts = rows.groupBy(tree, "_part").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(  # one row a tree and partition
        tree, "_part", "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(tree)).alias("size"),
    )
    place = F.col("_n") - F.col("_first") + F.col("_before")
    return rows.join(counts, [tree, "_part"]).withColumn("index", place).drop("_n", "_part", "_first", "_before")


class Manifest:
    """The manifest of ``docs``: leaves, the sources' logs and the log over their subroots.

    ``altered`` (field -> column) says what a leaf's ``checked`` digest is made of instead, to verify a table that
    may differ from the manifest's: the same rows, some of whose values have changed.
    """

    def __init__(
        self,
        docs: DataFrame,
        *,
        id_col: str = "doc_id",
        source_col: str = "source",
        fields: Sequence[str] = FIELDS,
        altered: dict[str, Column] | None = None,
    ):
        bounded_batches(docs.sparkSession)
        self.scratch = scratch = Scratch(docs.sparkSession)
        columns = {c: F.col(f"`{c}`") for c in fields}
        leaves = docs.select(
            F.col(f"`{id_col}`").alias("id"),
            # never null, and in order: "-" for no source, "=" before any other
            F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("-")).alias("source"),
            leaf_digest(list(columns.values())).alias("digest"),
            leaf_digest(list((columns | (altered or {})).values())).alias("checked"),
            F.monotonically_increasing_id().alias("tie"),
        )
        leaves = indexed(scratch.write(leaves, "digests"), scratch, "ordered", "source", "id", "digest", "tie")
        sources = indexed(
            leaves.where("index = 0").select(F.lit(0).alias("all"), "source"), scratch, "ordered-sources", "all", "source"
        )
        #: (source, tree, trees): a source's number is its place in order
        self.sources = scratch.write(sources.selectExpr("source", "index AS tree", "size AS trees"), "sources")
        carried = F.struct("id", "checked").alias("carried")
        #: the sources' logs, a relation a pass
        self.passes = append_log(leaves.join(self.sources, "source").select("tree", "size", "index", "digest", carried), scratch, "log")
        #: (tree, digest) of every source
        self.subroots = scratch.write(tops(self.passes), "subroots")
        subroots = self.subroots.join(self.sources, "tree").selectExpr(
            "CAST(0 AS BIGINT) AS tree", "trees AS size", "tree AS index", "digest", "struct(source) AS carried"
        )
        #: the log over them
        self.top_passes = append_log(subroots, scratch, "top")

    def root(self) -> str | None:
        """The digest of the whole dataset."""
        found = tops(self.top_passes).first()
        return found and found["digest"]

    def log(self) -> DataFrame:
        """(tree, size, level, index, position, digest): the sources' logs, each by position in postorder."""
        out = None
        for n, log in enumerate(self.passes):
            own = (log.where(f"level > {n * HEIGHT}") if n else log).drop("carried")
            out = own if out is None else out.union(own)
        return out

    def _leaves(self, checked: str | None) -> DataFrame:
        top = self.scratch.write(paths(self.top_passes).selectExpr("index AS tree", "path"), "top-paths")
        subroots = self.subroots.withColumnRenamed("digest", "subroot")
        return paths(self.passes, top, checked).join(subroots, "tree").withColumn("root", F.lit(self.root()))

    def proofs(self) -> DataFrame:
        """(id, leaf, subroot, root, path) of every row; ``path`` has its siblings from its own level to the root."""
        return self._leaves(None).select("carried.id", F.col("digest").alias("leaf"), "subroot", "root", "path")

    def verified(self) -> DataFrame:
        """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: the digest of its siblings,
        what its checked digest gives with them, and whether that is the root."""
        return self._leaves("checked").select(
            "carried.id",
            F.col("digest").alias("leaf"),
            "subroot",
            "root",
            "proof_sha256",
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
