"""Near-duplicate detection by DartMinHash signatures and a banded join.

Elements of a document are its ``shingle``-word runs (of normalised words; a text of fewer
words is one element), each with a weight: 1, or how often it occurs. *Darts* are thrown into
the plane element weight x rank: every unit cell of an element's weight gets a Poisson process
of darts along the rank axis, made by hashing the element, the cell and the dart's number, so
all documents see the same darts. A dart counts if it falls inside the document's own weight of
the element. Each dart carries a coordinate; the signature keeps the earliest (lowest rank) dart
of each. Only the darts below a rank bound of about k (ln k + 3) / total weight are thrown, some
8 k for a document whatever its length; in the rare case that a coordinate stays empty the
bound is doubled. Two documents agree in a coordinate with the probability of their weighted
Jaccard similarity.

Signatures are cut into ``bands`` of ``rows`` coordinates; documents that agree in a band share a
bucket. Equal texts are one node from the start. Within a bucket no pairs are listed: its
members are compared with pivots, the member whose buckets hold most documents (the centre of a
group of copies), the next such member outside the first one's class, and one drawn anew each
round. Each comparison is the exact similarity of the two texts; links join classes
(``components``), and further rounds compare what is still apart in a common bucket, until
``PATIENCE`` rounds find hardly any link. A round costs at most three comparisons a member and bucket,
each pair of texts being compared once. What of a bucket is in one class needs no comparison,
so groups of copies end early. Members of a bucket that are still in different classes then are
joined exactly (``_finish``): two texts alike share an element among the rarest of each (prefix
filter, the prefix being that for the sizes of both), and what meets there in another class, and
can be alike by the place of the common element, is compared. So nothing that shares a bucket
is missed.

Scale: one pass for signatures; band rows, pivots and classes are aggregated map-side first; a
bucket that holds a third of all documents gives each of them a few comparisons, and the joins it
makes hot are ones that Spark splits. Texts move once to meet the nodes that share a bucket,
then only those move.

Defined results: a document's class is the smallest id in it; a text without words (or null)
is alike to nothing and keeps its own id; rows that repeat an id have one class by text; a null id never
names a class that has another id.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, mix64, rows, texts, written
from .components import components
from .decontaminate import normal_words

SHINGLE = 5
SIMILARITY = 0.8
#: 25 bands of 6: a pair of similarity 0.8 shares a band with probability 0.9995, of 0.3 with 0.02
BANDS = 25
ROWS = 6

#: rounds, one after the other, that end the comparisons with pivots, if fewer than this share of
#: their pairs are links; the exact join does the rest
PATIENCE = 2
FRUITFUL = 0.01

#: the exact join: counters of the order by frequency (elements that share one are counted together,
#: which changes the order and so the work, not the result), ratio of the bounds of a class of sizes,
#: and rows of a key above which it is salted
BINS = 1 << 20
SIZE_STEP = 1.03
HOT = 500

#: cells and darts of the documents signed at a time (some 50 bytes of a worker's memory each)
CHUNK = 300_000

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1


def shingles(words: WordHashes, text: bytes, size: int) -> np.ndarray:
    """The hash of every run of ``size`` normalised words (of all words, if fewer)."""
    seq = normal_words(text)
    if not seq:
        return np.empty(0, np.uint64)
    h = words.of(seq)
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(min(size, len(h))):
        out = mix64(out ^ h[j : j + n])
    return out


def throw_darts(
    elements: np.ndarray, weights: np.ndarray, doc: np.ndarray, n_docs: int, k: int, more: float = 1.0
) -> np.ndarray:
    """Signatures (n_docs x k dart ids) of documents given as (element, weight, document) rows.

    Every document must have some element of positive weight.
    """
    total = np.bincount(doc, weights, n_docs)
    bound = more * k * (math.log(k) + 3) / total
    cells = np.ceil(weights).astype(np.int64)
    cell_doc = np.repeat(doc, cells)
    number = np.arange(len(cell_doc)) - np.repeat(np.cumsum(cells) - cells, cells)
    inside = np.repeat(weights, cells) - number  # the part of the cell that the weight covers
    key = mix64(np.repeat(elements, cells) ^ mix64(number.astype(np.uint64) + np.uint64(_ODD[0])))
    limit, rank = bound[cell_doc], np.zeros(len(key))
    found = []
    step = 0
    while len(key):
        step += 1
        gap = mix64(key + np.uint64(step * _ODD[1] & _MASK))
        rank = rank - np.log(((gap >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        live = rank <= limit
        key, rank, limit, cell_doc, inside = key[live], rank[live], limit[live], cell_doc[live], inside[live]
        dart = mix64(key ^ np.uint64(step * _ODD[2] & _MASK))
        slot = cell_doc * k + (dart % np.uint64(k)).astype(np.int64)
        at = (mix64(dart ^ np.uint64(_ODD[3])) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        hit = at < inside
        found.append((slot[hit], rank[hit], dart[hit]))
    slot, rank, dart = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((rank, slot))
    slot = slot[order]
    first = np.concatenate(([True], slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, bool)
    out = np.zeros(n_docs * k, np.uint64)
    have = np.zeros(n_docs * k, bool)
    out[slot[first]], have[slot[first]] = dart[order][first], True
    out, short = out.reshape(n_docs, k), ~have.reshape(n_docs, k).all(axis=1)
    if short.any():
        place = np.cumsum(short) - 1
        rows_of = short[doc]
        out[short] = throw_darts(elements[rows_of], weights[rows_of], place[doc[rows_of]], int(short.sum()), k, 2 * more)
    return out


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = signatures.reshape(len(signatures), bands, -1)
    key = np.broadcast_to(mix64(np.arange(bands, dtype=np.uint64)), parts.shape[:2]).copy()
    for j in range(parts.shape[2]):
        key = mix64(key ^ parts[:, :, j])
    return key


def _weighted(h: np.ndarray, weigh: str) -> tuple[np.ndarray, np.ndarray]:
    own, times = np.unique(h, return_counts=True)
    return own, times.astype(np.float64) if weigh == "count" else np.ones(len(own))


def _sign(size, weigh, bands, width, batches):
    words = WordHashes()
    expected = int(bands * width * (math.log(bands * width) + 3))  # darts a document
    for b in batches:
        text = b.column("_text").to_pylist()
        own_rows, node, keys = [], [], []
        group: list[tuple[np.ndarray, np.ndarray]] = []  # weighted sets not signed yet
        cells = 0
        for n, t in enumerate(text, 1):
            h = shingles(words, t, size)
            if len(h):
                own_rows.append(n - 1)
                node.append(xxhash.xxh3_64_intdigest(b" ".join(normal_words(t))) - (1 << 63))
                group.append(_weighted(h, weigh))
                cells += len(h) + expected
            if group and (cells >= CHUNK or n == len(text)):
                elements, weights = (np.concatenate(part) for part in zip(*group))
                doc = np.repeat(np.arange(len(group)), [len(own) for own, _ in group])
                signed = throw_darts(elements, weights, doc, len(group), bands * width)
                keys.extend(band_keys(signed, bands).view(np.int64).tolist())
                group, cells = [], 0
        if node:
            take = pa.array(own_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").take(take), b.column("_key").take(take), pa.array(node, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["_id", "_key", "node", "keys"],
            )


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets (sorted elements, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    return common / (a[1].sum() + b[1].sum() - common)


def _compare(size, weigh, least, batches):
    words, pivots = WordHashes(), {}
    for node, pivot, text, pivot_text in rows(batches, "node", "pivot", "text", "pivot_text"):
        same = []
        for p, t, pt in zip(pivot, text, pivot_text):
            if p not in pivots:
                if len(pivots) >= 64:
                    pivots.clear()
                pivots[p] = _weighted(shingles(words, pt, size), weigh)
            # the sums of weights are whole: 1e-9 only stands against rounding in the division
            same.append(similarity(_weighted(shingles(words, t, size), weigh), pivots[p]) >= least - 1e-9)
        keep = [k for k, x in enumerate(same) if x]
        if keep:
            yield pa.RecordBatch.from_arrays(
                [pa.array([node[k] for k in keep], pa.int64()), pa.array([pivot[k] for k in keep], pa.int64())], ["u", "v"]
            )


def _elements(words: WordHashes, text: bytes, size: int, weigh: str) -> np.ndarray:
    """The weighted set as a plain one: an element of weight w is w elements."""
    own, weights = _weighted(shingles(words, text, size), weigh)
    times = weights.astype(np.int64)
    if (times == 1).all():
        return own
    number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(own, times) ^ np.where(number > 0, mix64(number.astype(np.uint64)), np.uint64(0))


def _bin(elements: np.ndarray) -> np.ndarray:
    return (mix64(elements) % np.uint64(BINS)).astype(np.int64)


def _count_bins(size, weigh, batches):
    words = WordHashes()
    for (text,) in rows(batches, "text"):
        found = [_bin(_elements(words, t, size, weigh)) for t in text]
        at, times = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(times)], ["bin", "n"])


def _least_common(least: float, total):
    """The fewest common elements of two sets of so many elements together that are alike."""
    return math.ceil(least / (1 + least) * total - 1e-6)


def _size_class(n: float) -> int:
    return math.floor(math.log(n) / math.log(SIZE_STEP))


def _prefixes(shared, size, weigh, least, batches):
    words, counts = WordHashes(), shared.value
    fields = ("element", "low", "high", "own", "node", "component", "size", "place")
    kinds = (np.int64, np.int32, np.int32, np.int32, np.int64, np.int64, np.int64, np.int64)
    for node, component, text in rows(batches, "node", "component", "text"):
        found: list[tuple] = []
        held = 0
        for k, (i, c, t) in enumerate(zip(node, component, text), 1):
            elements = _elements(words, t, size, weigh)
            n, often = len(elements), counts[_bin(elements)]
            order = np.lexsort((elements, often))
            elements, some = elements[order].view(np.int64), often[order] > 1  # others are in no other text
            own = _size_class(n)
            for other in range(_size_class(max(1.0, least * n * (1 - 1e-9))), _size_class(n / least * (1 + 1e-9)) + 1):
                smallest = max(SIZE_STEP**other * (1 - 1e-9), least * n)
                at = np.flatnonzero(some[: max(0, n - _least_common(least, n + smallest) + 1)])
                if len(at):
                    found.append((elements[at], min(own, other), max(own, other), own, i, c, n, at))
                    held += len(at)
            if found and (held >= CHUNK or k == len(node)):
                lengths = [len(f[0]) for f in found]
                columns = [np.concatenate([f[0] for f in found])]
                columns += [np.repeat(np.array([f[j] for f in found], kinds[j]), lengths) for j in range(1, 7)]
                columns.append(np.concatenate([f[7] for f in found]))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.from_numpy_dtype(d)) for x, d in zip(columns, kinds)], list(fields))
                found, held = [], 0


def _finish(apart: DataFrame, size: int, weigh: str, least: float) -> DataFrame:
    """Pairs (u, v) of different components of ``apart`` (node, component, text) that can be alike:
    every pair that is alike is among them."""
    spark = apart.sparkSession
    counts = np.zeros(BINS, np.int32)
    # at most BINS rows reach the driver
    binned = apart.select("text").mapInArrow(partial(_count_bins, size, weigh), "bin bigint, n bigint")
    often = binned.groupBy("bin").agg(F.least(F.sum("n"), F.lit(2**31 - 1)).cast("int").alias("n")).where("n > 1").toArrow()
    counts[often.column("bin").to_numpy()] = often.column("n").to_numpy()
    shared = spark.sparkContext.broadcast(counts)
    prefix = written(
        apart.mapInArrow(
            partial(_prefixes, shared, size, weigh, least),
            "element bigint, low int, high int, own int, node bigint, component bigint, size bigint, place bigint",
        ),
        "prefixes",
    )
    key = ["element", "low", "high"]
    # keys of one component, or without a partner of the other size, join nothing
    met = prefix.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("c"), F.max("component").alias("d"),
        F.min("own").alias("a"), F.max("own").alias("b"),
    ).where("c != d AND a = low AND b = high").select(*key, F.ceil(F.col("n") / HOT).cast("int").alias("salts"))
    salted = prefix.join(met, key).withColumn("mine", F.pmod(F.xxhash64("node"), "salts").cast("int"))
    cells = salted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    side = "element, low, high, {0} AS s, {1} AS t, node AS {2}, component AS {2}_c, size AS {2}_n, place AS {2}_p"
    left = cells.where("own = low").selectExpr(*side.format("mine", "other", "x").split(", "))
    right = cells.where("own = high").selectExpr(*side.format("other", "mine", "y").split(", "))
    both = left.join(right, [*key, "s", "t"]).where(
        f"""x_c != y_c AND (low < high OR x < y)
        AND least(x_n - x_p, y_n - y_p) >= ceil({least / (1 + least)!r}D * (x_n + y_n) - 1e-6D)"""
    )
    return both.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()


def _pivots(members: DataFrame) -> DataFrame:
    """Pairs (node, pivot) of members of a bucket that are in different classes."""
    best = F.max(F.struct("weight", "node", "component")).alias("hub")
    drawn = F.min(F.struct("draw", "node", "component")).alias("drawn")
    split = members.groupBy("bucket").agg(
        best, drawn, F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low != high")
    apart = members.join(split.select("bucket", "hub", "drawn"), "bucket")
    second = apart.where("component != hub.component").groupBy("bucket").agg(best).withColumnRenamed("hub", "second")
    both = apart.join(second, "bucket")
    pairs = None
    for pivot in ("hub", "second", "drawn"):
        own = both.where(f"component != {pivot}.component").selectExpr("node", f"{pivot}.node AS pivot")
        pairs = own if pairs is None else pairs.union(own)
    return pairs.select(F.least("node", "pivot").alias("u"), F.greatest("node", "pivot").alias("v"), "node", "pivot").dropDuplicates(
        ["u", "v"]
    )


def classes_by_text(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    least: float = SIMILARITY,
    weigh: str = "one",
    bands: int = BANDS,
    width: int = ROWS,
) -> DataFrame:
    """(_key, class_id): the class of every text that has words, by ``text_key``.

    ``weigh``: "one" for the similarity of shingle sets, "count" for that of shingle counts.
    """
    base = texts(docs, id_col, text_col, binary=True).withColumn("_key", F.xxhash64("_text"))
    id_type = base.schema["_id"].dataType.simpleString()
    signed = written(
        base.mapInArrow(
            partial(_sign, shingle, weigh, bands, width), f"_id {id_type}, _key bigint, node bigint, keys array<bigint>"
        ),
        "signatures",
    )
    # equal texts are one node, read from its smallest document
    nodes = signed.groupBy("node").agg(
        F.min(F.struct(F.col("_id").isNull(), "_id", "_key")).alias("own"), F.first("keys").alias("keys")
    )
    nodes = written(nodes.selectExpr("node", "own._id AS _id", "own._key AS _key", "keys"), "nodes")
    buckets = nodes.select("node", F.explode("keys").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(buckets.join(shared, "bucket"), "buckets")
    weight = met.groupBy("node").agg(F.sum("n").alias("weight"))
    met = met.select("bucket", "node")

    candidates = nodes.join(weight, "node").select("node", "weight", "_id", "_key")
    text = written(
        base.join(candidates, base["_id"].eqNullSafe(candidates["_id"]) & (base["_key"] == candidates["_key"]))
        .groupBy("node")
        .agg(F.min("_text").alias("text")),  # rows that repeat the document do not repeat the node
        "candidates",
    )

    def alike(pairs: DataFrame) -> DataFrame:
        other = text.select(F.col("node").alias("pivot"), F.col("text").alias("pivot_text"))
        return written(
            pairs.join(text.select("node", "text"), "node").join(other, "pivot")
            .mapInArrow(partial(_compare, shingle, weigh, least), "u bigint, v bigint"),
            "links",
        )

    classes = weight.select("node", "weight", F.col("node").alias("component"))
    links = compared = None
    turn = barren = 0
    while barren < PATIENCE:
        members = met.join(classes, "node").withColumn("draw", F.xxhash64("node", "bucket", F.lit(turn)))
        pairs = _pivots(members)
        if compared is not None:
            pairs = pairs.join(compared, ["u", "v"], "left_anti")
        pairs = written(pairs, "pairs")
        new = alike(pairs.select("node", "pivot"))
        done = pairs.select("u", "v")
        compared = done if compared is None else compared.union(done)
        turn += 1
        n_pairs, n_new = pairs.count(), new.count()
        barren = PATIENCE if not n_pairs else 0 if n_new >= FRUITFUL * n_pairs else barren + 1
        if not n_new:
            continue
        links = new if links is None else links.union(new)
        found = written(components(links), "classes")
        classes = weight.join(found, "node", "left").select(
            "node", "weight", F.coalesce("component", "node").alias("component")
        )
    members = met.join(classes, "node")
    mixed = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    open_nodes = members.join(mixed.select("bucket"), "bucket").select("node", "component").distinct()
    apart = written(open_nodes.join(text, "node").select("node", "component", "text"), "apart")
    if not apart.isEmpty():
        pairs = _finish(apart, shingle, weigh, least)
        if compared is not None:
            pairs = pairs.join(compared, ["u", "v"], "left_anti")
        new = alike(written(pairs.selectExpr("u AS node", "v AS pivot"), "pairs"))
        if not new.isEmpty():
            links = new if links is None else links.union(new)
            found = written(components(links), "classes")
    if links is None:
        named = nodes.select("node", F.col("_id").alias("class_id"))
    else:
        of = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        lowest = of.groupBy("component").agg(F.min("_id").alias("class_id"))
        named = of.join(lowest, "component").select("node", "class_id")
    return written(signed.select("_key", "node").distinct().join(named, "node").select("_key", "class_id"), "named")


def text_key(text_col: str) -> Column:
    """The key of a text in ``classes_by_text``."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """Per document row: id and class_id, the smallest id of its class of near copies."""
    classes = classes_by_text(docs, id_col=id_col, text_col=text_col, **settings)
    ids = docs.select(F.col(f"`{id_col}`").alias("_id"), text_key(text_col).alias("_key"))
    return ids.join(classes, "_key", "left").select(
        F.col("_id").alias(id_col), F.coalesce("class_id", "_id").alias("class_id")
    )


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the document with the smallest id.

    Rows that repeat that id all stay; so do rows without an id unless a copy of theirs has one.
    """
    classes = classes_by_text(docs, id_col=id_col, text_col=text_col, **settings)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    keyed = docs.select(row, F.col(f"`{id_col}`").alias("_id"), text_key(text_col).alias("_key"))
    stays = keyed.join(classes, "_key", "left").where(F.col("class_id").isNull() | F.col("class_id").eqNullSafe(F.col("_id")))
    return stays.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))
