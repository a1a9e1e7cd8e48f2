"""Near duplicates by a chosen-path similarity join over sets of word shingles.

Texts with equal sets form a class, and only classes are compared. In each of several independent trees, the classes
start at the node of one of their minwise values; a node with more than ``LEAF`` members is branched by a further
minwise value, chosen by the node itself, and so on, until a node is small or branching has left it more than half of
its parent's members, as with a group of near copies. In a small node all members are compared by short sketches. In a
dense one every member is compared with a few others, so that over the trees a group of any size hangs together without
all of its pairs. Pairs that the sketches find similar are confirmed on the full sets, first a forest of them, then all
that it leaves in different components. Dense nodes at last compare the members outside their most frequent component
with all others, in packets, in every tree.

A pair at the threshold of 0.8 stays together in one tree down to level L with a probability of 0.8^L. Sixteen trees keep
the chance to miss it below three in ten thousand down to the fourth level. Texts that get deeper in some tree go through
as many further trees as their deepest level needs for that (21 for the fifth, 45 for the eighth, 114 for the twelfth),
again and again until no text gets deeper than its trees allow. Roots repeat their coordinate after 64 trees.

Words are split at ASCII white space after A-Z are folded. A text of fewer words than a shingle has one shingle, its
whole sequence; one without words (also NULL) has none and is linked with nothing. A NULL id counts only where a
component has no other. Repeated rows stay, with equal results. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import count
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from chargelake.llm.common import row_key
from chargelake.llm.graph import components
from chargelake.staging import fits_broadcast, staged

TREES = 16
LEVELS = 12
LEAF = 40
COORDINATES = 64
PACKET = 100
LISTS_TOGETHER = 8
MISS = 3e-4
ROWS_PER_TASK = 1 << 14
SPREAD = 4.4  # standard deviations that a sketch may fall short of the threshold

_RANDOM = np.random.default_rng(20240611)
_FLIP = _RANDOM.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)[:, None]
_TURN = _RANDOM.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, size: int) -> set[bytes]:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if len(words) >= size:
        return set(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))
    return {b" ".join(words)} if words else set()


def minwise(hashes: np.ndarray) -> np.ndarray:
    """The least value of each coordinate's permutation, in pieces of bounded memory."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 4096):
        np.minimum(least, ((hashes[None, at : at + 4096] ^ _FLIP) * _TURN).min(axis=1), out=least)
    return least


def sketch_rows(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, key, n, cid, nodes, sketch) per row; ``cid`` is a digest of the set, NULL for an empty one."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, nodes, sketches = [], [], [], []
            for text in batch.column(2):
                own = shingles(text.as_py(), size)
                counts.append(len(own))
                if not own:
                    digests.append(None), nodes.append(None), sketches.append(None)
                    continue
                hashes = np.fromiter(map(xxh3_64_intdigest, own), np.uint64, len(own))
                hashes.sort()
                least = minwise(hashes) * _MIX
                digests.append(blake2b(b"\n".join(sorted(own)), digest_size=16).digest())
                nodes.append((least[:TREES] ^ np.arange(TREES, dtype=np.uint64)).view(np.int64).tolist())
                sketches.append((least >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(nodes, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["id", "key", "n", "cid", "nodes", "sketch"])

    rows = docs.select(
        F.col(id_col).alias("id"), row_key(F.col(id_col), F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(sketch, f"id {kind}, key struct<a:bigint,b:bigint>, n bigint, cid binary, nodes array<bigint>, sketch binary")


def trees_for(level: int, percent: int) -> int:
    """Trees in which a pair at the threshold is parted above ``level`` in all of them with a chance of at most ``MISS``."""
    together = (percent / 100) ** level
    return TREES if together >= 1 else max(TREES, ceil(log(MISS) / log(1 - together)))


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def least_equal(percent: int) -> int:
    """Sketch bytes that must agree at least."""
    share = percent / 100
    return int(COORDINATES * share - SPREAD * (COORDINATES * share * (1 - share)) ** 0.5)


def agreement(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, percent: int) -> np.ndarray:
    """Sketch bytes in which pairs agree; 0 where sketches or sizes of the sets rule out the threshold."""
    same = np.zeros(len(left), np.int64)
    at = np.flatnonzero(100 * np.minimum(n_left, n_right) >= percent * np.maximum(n_left, n_right))
    for part in np.array_split(at, len(at) // 65536 + 1):
        same[part] = (left[part] == right[part]).sum(axis=1)
    return np.where(same >= least_equal(percent), same, 0)


def packets_of(rows: DataFrame, label: str, most: int | None = None) -> DataFrame:
    """Members of each node that has two or more, in lists of bounded length, with the node's size.

    ``dense`` nodes are large and hold more than half of ``parent``, the members of the node they were branched from.
    Sizes are combined before the shuffle and meet the rows again in a join, which can be split where a
    node is hot. Lists of large nodes are cut by the members' ids. ``most`` rows, if known, are written by no more
    tasks than they need, as deep levels are many and small.
    """
    sized = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.first("parent").alias("parent"), F.first("used").alias("used"))
    dense = (F.col("size") > LEAF) & (F.col("size") * 2 > F.col("parent"))
    sized = sized.filter("size > 1").select("node", "size", "used", F.coalesce(dense, F.lit(False)).alias("dense"))
    joined = rows.drop("used").join(sized, "node")
    slot = F.pmod(F.xxhash64("cid"), F.ceil(F.col("size") * 2 / LEAF))
    joined = joined.withColumn("slot", F.when(F.col("size") <= LEAF, F.lit(0).cast("bigint")).otherwise(slot))
    packed = joined.groupBy("node", "slot").agg(
        F.first("size").alias("size"), F.first("dense").alias("dense"), F.first("tree").alias("tree"), F.first("used").alias("used"),
        F.array_sort(F.collect_list(F.struct("cid", "n", "sketch"))).alias("members"))
    packed = packed.select("node", "tree", "size", "dense", "used", "members")
    return staged(packed if most is None else packed.coalesce(max(1, -(-most // ROWS_PER_TASK))), label, "zstd")


def coordinate(tree: Column) -> Column:
    """The place, from 0, whose value is the root of a tree."""
    return F.pmod(tree, F.lit(COORDINATES)).cast("int")


def unused_coordinate(node: Column, used: Column) -> Column:
    """A place that no branching above a node has used, chosen by the node. ``used`` has a bit for each place."""
    free = F.filter(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda place: F.getbit(used, place) == 0)
    return F.get(free, F.pmod(F.xxhash64(node), F.lit(COORDINATES) - F.bit_count(used)).cast("int"))


def pairs_of(packets: DataFrame, percent: int) -> DataFrame:
    """(x, y, same): pairs found similar by sketch, y the greater, and in how many bytes they agree.

    All pairs of a small node; in each list of a dense node, every member with the most similar one before it.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                yield from pairs(batch.slice(at, 2000))

    def pairs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column("members")
        lengths = np.array([len(x) for x in lists], np.int64)
        large = batch.column("size").to_numpy(zero_copy_only=False) > LEAF
        members = lists.flatten()
        cid, sketch = _fixed(members.field("cid"), 16), _fixed(members.field("sketch"), COORDINATES)
        n = members.field("n").to_numpy(zero_copy_only=False)
        starts, owner = np.cumsum(lengths) - lengths, np.repeat(np.arange(batch.num_rows), lengths)
        one, other = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length in np.unique(lengths):
            i, j = np.triu_indices(length, 1)
            first = starts[lengths == length][:, None]
            one.append((first + i).ravel()), other.append((first + j).ravel())
        one, other = np.concatenate(one), np.concatenate(other)
        same = agreement(sketch[one], sketch[other], n[one], n[other], percent)
        one, other, same = one[same > 0], other[same > 0], same[same > 0]
        order = np.lexsort((one, -same, other))
        one, other, same = one[order], other[order], same[order]
        best = np.concatenate([[True], other[1:] != other[:-1]])[: len(other)]
        kept = best | ~large[owner[other]]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([row.tobytes() for row in cid[ends[kept]]], pa.binary()) for ends in (one, other)), pa.array(same[kept])],
            names=["x", "y", "same"])

    return packets.select("size", "members").mapInArrow(compare, "x binary, y binary, same bigint")


def best_pairs(pairs: DataFrame) -> DataFrame:
    """(x, y): each member with the partner it agrees with most."""
    ends = pairs.select(F.col("x").alias("me"), "same", F.col("y").alias("other")).unionAll(
        pairs.select(F.col("y").alias("me"), "same", F.col("x").alias("other")))
    best = ends.groupBy("me").agg(F.max(F.struct("same", "other")).alias("best"))
    return best.select(F.least("me", "best.other").alias("x"), F.greatest("me", "best.other").alias("y")).distinct()


class Texts:
    """The documents by class: each class is read through one of its texts."""

    def __init__(self, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> None:
        self.classes = classes.select("cid", "key")
        self.docs = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text"))

    def of(self, cids: DataFrame) -> DataFrame:
        wanted = staged(self.classes.join(cids.select("cid").distinct(), "cid"), "wanted")
        found = self.docs.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "key")
        return staged(found.groupBy("cid").agg(F.first("text").alias("text")), "texts", "zstd")


def intersections(left: list[set[bytes]], right: list[set[bytes]], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each set with each, by products of 0/1 matrices over runs of shingles."""
    shared = list(set().union(*left) & set().union(*right))
    sizes = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(shared), columns):
        place = {shingle: i for i, shingle in enumerate(shared[at : at + columns])}
        held = []
        for sets in (left, right):
            matrix = np.zeros((len(sets), len(place)), np.float32)
            for row, own in enumerate(sets):
                matrix[row, [place[shingle] for shingle in own if shingle in place]] = 1
            held.append(matrix)
        sizes += held[0] @ held[1].T
    return sizes.astype(np.int64)


def linked(one: set[bytes], other: set[bytes], percent: int) -> bool:
    common = len(one & other)
    return 100 * common >= percent * (len(one) + len(other) - common)


def confirmed(pairs: DataFrame, texts: Texts, size: int, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets reach the threshold."""
    used = texts.of(pairs.select(F.explode(F.array("x", "y")).alias("cid")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[bytes]] = {}

        def of(text: str) -> set[bytes]:
            if text not in known:
                if len(known) > 32:
                    known.clear()
                known[text] = shingles(text, size)
            return known[text]

        for batch in batches:
            both = zip(batch.column("text_x"), batch.column("text_y"), strict=True)
            kept = [linked(of(a.as_py()), of(b.as_py()), percent) for a, b in both]
            yield batch.select(["x", "y"]).filter(pa.array(kept, pa.bool_()))

    half = pairs.join(used.withColumnsRenamed({"cid": "y", "text": "text_y"}), "y")
    both = half.join(used.withColumnsRenamed({"cid": "x", "text": "text_x"}), "x")
    return both.select("x", "y", "text_x", "text_y").mapInArrow(verify, "x binary, y binary")


def in_different(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends have different labels; an end without a label is its own."""
    named = pairs
    for end in ("x", "y"):
        own = labels.withColumnsRenamed({"node": end, "label": f"label_{end}"})
        named = named.join(own, end, "left").withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))
    return named.filter("label_x <> label_y").select(*pairs.columns)


def small_side(lookup: DataFrame) -> DataFrame:
    """A stored table with one row per dense node, broadcast while it is measured to be small."""
    return F.broadcast(lookup) if fits_broadcast(lookup) else lookup


def meet_before(node: int, left: list[list[int]], right: list[list[int]]) -> np.ndarray:
    """Whether each of the one and each of the others share a node that is less than this one."""
    place = {one: i for i, one in enumerate({one for nodes in left for one in nodes if one < node})}
    held = [np.zeros((len(part), len(place)), np.float32) for part in (left, right)]
    for matrix, part in zip(held, (left, right), strict=True):
        for row, nodes in enumerate(part):
            matrix[row, [place[one] for one in nodes if one in place]] = 1
    return held[0] @ held[1].T > 0


def left_edges(packets: DataFrame, labels: DataFrame, texts: Texts, size: int, percent: int) -> DataFrame:
    """Links (x, y) in dense nodes, of members outside the most frequent component and any others.

    Lists of such members meet the lists of all members of their node, dealt by node and share. A meeting compares at most a packet of the ones
    with a packet of the others, by sketch and then on the full sets, and gives no more links than connect components.
    Two members that share several nodes, as in many trees, are compared in the least of them only: they differ in their
    component, so one of them is outside the most frequent one there too.
    """
    members = packets.select("node", F.inline("members")).join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    members = staged(members.select("node", "cid", "n", "sketch", F.coalesce("label", "cid").alias("own")), "members", "zstd")
    main = members.groupBy("node", "own").agg(F.count(F.lit(1)).alias("rows")).groupBy("node").agg(F.max(F.struct("rows", "own")).alias("main"))
    members = members.join(small_side(staged(main.select("node", F.col("main.own").alias("main")), "main")), "node")
    some = members.filter("own <> main")
    if some.isEmpty():
        return some.select(F.col("cid").alias("x"), F.col("own").alias("y"))
    every = members.join(small_side(staged(some.select("node").distinct(), "nodes")), "node", "left_semi")
    used = texts.of(every).join(every.groupBy("cid").agg(F.collect_set("node").alias("nodes")), "cid")

    def sizes(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / PACKET).alias(name))

    cuts = small_side(staged(sizes(some, "some_lists").join(sizes(every, "all_lists"), "node"), "sizes"))
    # A node's lists are dealt over shares of a few lists; the lists of some members go to each share.
    shares = F.ceil(F.col("all_lists") / LISTS_TOGETHER)

    def lists(rows: DataFrame, count: str, name: str) -> DataFrame:
        cut = rows.join(used, "cid").join(cuts, "node").withColumn("slot", F.pmod(F.xxhash64("cid"), F.col(count)))
        listed = F.collect_list(F.struct("cid", "own", "n", "sketch", "text", "nodes")).alias(name)
        return cut.groupBy("node", "slot").agg(listed, F.first(shares).alias("shares"))

    left = lists(some, "some_lists", "some").select("node", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share"), "some")
    right = lists(every, "all_lists", "all").select("node", F.pmod("slot", "shares").alias("share"), "all")
    met = left.join(right, ["node", "share"]).select("node", "some", "all")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                left, right = batch.column("some")[row].as_py(), batch.column("all")[row].as_py()
                yield meet(batch.column("node")[row].as_py(), left, right)

    def meet(node: int, left: list[dict], right: list[dict]) -> pa.RecordBatch:
        i, j = np.nonzero(~meet_before(node, *([m["nodes"] for m in part] for part in (left, right))))
        sketches = [np.frombuffer(b"".join(m["sketch"] for m in part), np.uint8).reshape(-1, COORDINATES) for part in (left, right)]
        n = [np.array([m["n"] for m in part]) for part in (left, right)]
        may = np.flatnonzero(agreement(sketches[0][i], sketches[1][j], n[0][i], n[1][j], percent))
        may = may[[left[i[at]]["own"] != right[j[at]]["own"] for at in may.tolist()]] if len(may) else may
        i, j = i[may], j[may]
        rows, columns = np.unique(i), np.unique(j)
        common = intersections([shingles(left[row]["text"], size) for row in rows], [shingles(right[row]["text"], size) for row in columns])
        common = common[np.searchsorted(rows, i), np.searchsorted(columns, j)] if len(may) else np.zeros(0, np.int64)
        links = np.flatnonzero(100 * common >= percent * (n[0][i] + n[1][j] - common))
        x, y, joined = [], [], {}

        def label(own: bytes) -> bytes:
            while own in joined:
                own = joined[own]
            return own

        for at in links.tolist():
            ends = left[i[at]], right[j[at]]
            names = label(ends[0]["own"]), label(ends[1]["own"])
            if names[0] != names[1]:
                joined[names[0]] = names[1]
                x.append(ends[0]["cid"]), y.append(ends[1]["cid"])
        return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["x", "y"])

    return met.mapInArrow(compare, "x binary, y binary")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2, percent: int = 80,
) -> DataFrame:
    """(id, key, n_shingles, component) per row; ``component`` is a struct of the least (id, key) linked with the row.

    ``key`` tells rows of different id or text apart.
    """
    rows = staged(sketch_rows(docs, id_col, text_col, size), "sketches")
    # NULL ids rank last, so that a component is named by one only if it has no other.
    named = F.struct(F.isnull("id").alias("unnamed"), "id", "key")
    classes = staged(
        rows.filter("cid IS NOT NULL").groupBy("cid").agg(
            F.min(named).alias("least"), F.min("key").alias("key"), F.first("n").alias("n"),
            F.first("nodes").alias("nodes"), F.first("sketch").alias("sketch")), "classes")

    none = F.lit(None).cast("bigint")
    own = F.call_function("shiftleft", F.lit(1).cast("bigint"), coordinate(F.col("tree"))).alias("used")
    level = classes.select("cid", "n", "sketch", F.posexplode("nodes").alias("tree", "node")).select("*", none.alias("parent"), own)
    found, dense, reached, rows_here = None, None, None, None
    for wave in count(1):
        for depth in range(LEVELS):
            if trees_for(depth + 1, percent) > TREES:
                here = level.select("cid", F.lit(trees_for(depth + 1, percent)).alias("trees"))
                reached = here if reached is None else reached.unionAll(here)
            packets = packets_of(level, f"level{depth}", rows_here)
            ends = (F.col("size") <= LEAF) | F.col("dense") | F.lit(depth == LEVELS - 1)
            last, open_nodes = packets.filter(ends), packets.filter(~ends)
            more, crowded = pairs_of(last, percent), last.filter(F.col("size") > LEAF)
            found, dense = (more, crowded) if found is None else (found.unionAll(more), dense.unionAll(crowded))
            rows_here = open_nodes.agg(F.sum(F.size("members"))).first()[0]
            if rows_here is None:
                break
            placed = open_nodes.withColumn("place", unused_coordinate(F.col("node"), F.col("used")))
            child = F.xxhash64("node", F.substring(F.col("sketch"), F.col("place") + 1, F.lit(1)))
            used = F.col("used").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place")))
            level = placed.select("node", "tree", "size", "place", used.alias("used"), F.inline("members")).select(
                "cid", "n", "sketch", "tree", child.alias("node"), F.col("size").alias("parent"), "used")
        if reached is None:
            break
        reached = staged(reached.groupBy("cid").agg(F.max("trees").alias("trees")), "reached")
        deeper = reached.filter(F.col("trees") > wave * TREES)
        until = F.least(F.col("trees"), F.lit((wave + 1) * TREES))
        rows_here = deeper.agg(F.sum(until - wave * TREES)).first()[0]
        if rows_here is None:
            break
        tree = F.explode(F.sequence(F.lit(wave * TREES), until - 1))
        root = F.xxhash64("tree", F.substring(F.col("sketch"), coordinate(F.col("tree")) + 1, F.lit(1)))
        level = classes.join(deeper, "cid").select("cid", "n", "sketch", tree.alias("tree")).select(
            "cid", "n", "sketch", "tree", root.alias("node"), none.alias("parent"), own)

    pairs = staged(found.groupBy("x", "y").agg(F.max("same").alias("same")), "pairs")
    texts = Texts(docs, classes, id_col, text_col)
    best = staged(best_pairs(pairs), "forest")
    edges = staged(confirmed(best, texts, size, percent), "confirmed")
    labels = staged(components(edges), "labels")
    rest = staged(in_different(pairs.join(best, ["x", "y"], "left_anti"), labels).select("x", "y"), "open")
    if not rest.isEmpty():
        edges = edges.unionAll(staged(confirmed(rest, texts, size, percent), "confirmed"))
        labels = staged(components(edges), "labels")
    if not dense.isEmpty():
        edges = edges.unionAll(staged(left_edges(dense, labels, texts, size, percent), "confirmed"))
        labels = staged(components(edges), "labels")

    named_classes = classes.select("cid", "least").join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    named_classes = staged(named_classes.withColumn("label", F.coalesce("label", "cid")), "named")
    heads = named_classes.groupBy("label").agg(F.min("least").alias("component"))
    of_class = staged(named_classes.join(heads, "label").select("cid", "component"), "components")
    joined = rows.select("id", "key", "n", "cid").join(of_class, "cid", "left")
    return joined.select(
        F.col("id").alias(id_col), "key", F.col("n").alias("n_shingles"),
        F.coalesce("component", named).alias("component"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of linked rows, with all columns: the one of the least id. Texts without words stay."""
    found = near_duplicates(docs, id_col, text_col, size, percent)
    gone = found.filter("n_shingles > 0 AND key <> component.key").select("key").distinct()
    keyed = docs.select(F.struct("*").alias("row"), row_key(F.col(id_col), F.col(text_col)).alias("key"))
    kept = keyed.join(gone, "key", "left_anti")
    # Repeats of a row share its key; one of them stays.
    return kept.groupBy("key").agg(F.first("row").alias("row")).select("row.*")
