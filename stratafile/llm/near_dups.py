"""Near-duplicate documents by SetSketch: band register values, rule pairs out by joint likelihood, verify on full sets.

1. One pass over the texts gives each document the size, a 128-bit fingerprint and the sketch of its set of 5-word
   shingles. Documents with equal sets form a class; its smallest doc_id stands for it from here on, so thousands of
   copies are one member.
2. Bands of five registers put the classes into buckets. Each member is paired with its bucket's smallest member (the
   hub): as many pairs as members, never all pairs of a bucket.
3. Pairs whose sizes and registers rule the threshold out are dropped; the rest is compared on full sets. Links are
   contracted to components.
4. Members that are still in another component than their hub's get a longer sketch (2048 registers) and are compared
   with the bucket's members outside their own component, first by the lowest bits of the registers, then on full sets,
   so no link between different components is lost. Buckets in which many members are apart (a passage that
   many documents share) are first refined: there a pair has to share two bands, so a link whose only shared band is such
   a bucket is lost, and the larger figure below holds.

A pair of similarity 0.75 shares no band with probability 8e-7, and fewer than two with 1.3e-5.

Defined results: words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; a text with fewer than 5 words has its whole sequence
as its one shingle; null or empty text has an empty set, is linked with nothing and is its own component; rows with the
same doc_id are one document, so their components are joined; a row without doc_id takes no part (component null, kept);
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafile.llm import setsketch
from stratafile.llm.quality_rules import free_name
from stratafile.llm.tables import stored
from stratafile.llm.words import U64, Words, mixed, rounds, sequence_hash, windows, words_of

SHINGLE, THRESHOLD = 5, 75  # words; percent
#: Members apart from their hub in one bucket, from which the bucket is refined; and ids that are broadcast at most.
CROWDED, BROADCAST_IDS = 500, 1 << 20
BITS = [f"bits{k}" for k in range(setsketch.BIT_WORDS)]


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct shingle hashes of all texts in one array, and how many each text has."""
    hashes = windows(words.hashes, SHINGLE)
    parts, sizes = [], np.zeros(len(words.first) - 1, np.int64)
    for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
        if b - a >= SHINGLE:
            own = np.sort(hashes[a : b - SHINGLE + 1])
            own = own[np.append(True, own[1:] != own[:-1])]
        elif b > a:
            own = np.array([sequence_hash(words.hashes[a:b])], U64)
        else:
            continue
        parts.append(own)
        sizes[i] = len(own)
    return (np.concatenate(parts) if parts else np.zeros(0, U64)), sizes


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rounds(batches):
        hashes, sizes = shingle_sets(words_of(batch.column("text"), lower=True))
        full = np.flatnonzero(sizes)
        prints: list = [None] * len(sizes)
        sketches: list = [None] * len(sizes)
        if len(full):
            starts = np.append(0, np.cumsum(sizes[full])[:-1])
            a = np.add.reduceat(mixed(hashes, 3), starts)
            b = np.add.reduceat(mixed(hashes, 5), starts)
            marks, regs = np.stack([a, b], 1), setsketch.registers(hashes, starts)
            for k, i in enumerate(full.tolist()):
                prints[i], sketches[i] = marks[k].tobytes(), regs[k].tobytes()
        columns = [batch.column("doc_id"), pa.array(sizes), pa.array(prints, pa.binary()), pa.array(sketches, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "fingerprint", "sketch"])


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, size, fingerprint and sketch of each row's shingle set; the last two are null for an empty set."""
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(_sketch_batches, "doc_id bigint, n_shingles bigint, fingerprint binary, sketch binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, setsketch.REGISTERS)


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            keys = setsketch.band_keys(_matrix(batch.column("sketch"))).view(np.int64)
            node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(node)], ["key", "node"])


def _plausible_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            sizes = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b")]
            good = setsketch.plausible(THRESHOLD / 100, *sizes, *[_matrix(batch.column(c)) for c in ("sketch_a", "sketch_b")])
            yield batch.select(["a", "b"]).filter(pa.array(good))


def plausible_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that neither the sizes nor the joint likelihood of the registers rule out."""
    for side in ("a", "b"):
        own = classes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(_plausible_batches, "a bigint, b bigint").distinct()


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rounds(batches):
        hashes, sizes = shingle_sets(words_of(batch.column("text"), lower=True))
        ends = np.cumsum(sizes)
        blobs = [hashes[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        full = pa.array(sizes > 0)  # a doc_id with several texts may have an empty one among them
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(blobs, pa.binary())], ["node", "hashes"]).filter(full)


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The full shingle sets of the documents whose ids are in ``nodes``; those are sent around only up to a size."""
    rows = docs.selectExpr("cast(doc_id as bigint) as node", "cast(text as string) as text")
    return rows.join(_sent(nodes), "node").mapInArrow(_set_batches, "node bigint, hashes binary").distinct()


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = np.zeros(len(batch), bool)
        columns = (batch.column("hashes_a"), batch.column("hashes_b"))
        for i in range(len(batch)):
            x, y = (np.frombuffer(c[i].as_buffer(), U64) for c in columns)
            if len(x) > len(y):
                x, y = y, x
            if not len(x) or 100 * len(x) < THRESHOLD * len(y):
                continue
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int((y[at] == x).sum())
            good[i] = 100 * both >= THRESHOLD * (len(x) + len(y) - both)
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _bit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [np.frombuffer(b.as_buffer(), U64) for b in batch.column("hashes")]
        sizes = np.array([len(x) for x in parts])
        at = 0
        while at < len(parts):  # in rounds of bounded size
            to = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:]), 1 << 19)))
            starts = np.append(0, np.cumsum(sizes[at:to])[:-1])
            bits = setsketch.low_bits(np.concatenate(parts[at:to]), starts)
            columns = [batch.column("node").slice(at, to - at), pa.array(sizes[at:to])]
            columns += [pa.array(np.ascontiguousarray(bits[:, k])) for k in range(setsketch.BIT_WORDS)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n_shingles", *BITS])
            at = to


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are alike enough."""
    for side in ("b", "a"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("hashes").alias(f"hashes_{side}")), side)
    return pairs.mapInArrow(_link_batches, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node that has an edge.

    Each round points every node at its smallest neighbour (itself if none is smaller), follows the pointers four steps
    and contracts the edges, until none is left. One row a round reaches the driver.
    """
    edges = edges.where("a <> b").select("a", "b")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select("node", F.least("node", "to").alias("to"))
        for _ in range(2):
            step = stored(step, "step")
            step = _follow(step, step, "node", "to")
        step = stored(step, "step")
        labels = step if labels is None else stored(_follow(labels, step, "node", "to"), "labels")
        for side in ("a", "b"):
            edges = edges.join(step.select(F.col("node").alias(side), F.col("to").alias(f"to_{side}")), side)
        edges = stored(edges.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).where("a <> b").distinct(), "edges")
        if not edges.take(1):
            return labels.select("node", F.col("to").alias("component"))


def _follow(pointers: DataFrame, step: DataFrame, node: str, to: str) -> DataFrame:
    """Pointers moved on by one map; what the map doesn't name stays."""
    on = step.select(F.col("node").alias(to), F.col("to").alias("_next"))
    return pointers.join(on, to, "left").select(node, F.coalesce("_next", to).alias(to))


def _differing(one: str, two: str) -> Column:
    counts = [F.bit_count(F.col(f"{one}_{b}").bitwiseXOR(F.col(f"{two}_{b}"))) for b in BITS]
    return sum(counts[1:], counts[0])


def cross_pairs(members: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs of one bucket whose components differ and whose sizes and register bits don't rule the threshold out.

    members: key, node, component, hub_component, earlier (the node's keys of other buckets that come first). Of such a
    pair at least one is apart from the hub's component; those members are joined with the bucket's others. Pairs inside
    the hub's component, the mass of a large group of copies, are never looked at, and a pair that shares several buckets
    is taken in the first.
    """
    rows = stored(members.join(bits, "node"), "members")
    one, two = (rows.select("key", *[F.col(c).alias(f"{s}_{c}") for c in rows.columns if c != "key"]) for s in ("x", "y"))
    one = one.where("x_component <> x_hub_component")
    small, large = F.least("x_n_shingles", "y_n_shingles"), F.greatest("x_n_shingles", "y_n_shingles")
    test = (
        (F.col("x_component") != F.col("y_component"))
        & ((F.col("y_component") == F.col("y_hub_component")) | (F.col("x_node") < F.col("y_node")))
        & (100 * small >= THRESHOLD * large)
        & (_differing("x", "y") <= setsketch.MAX_BITS)
        & ~F.arrays_overlap("x_earlier", "y_earlier")
    )
    pairs = one.join(two, "key").where(test)
    return pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def leftover(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component: key, node, component, hub_component, earlier."""
    for side in ("node", "hub"):
        own = labels.select(F.col("node").alias(side), F.col("component").alias(f"{side}_component"))
        members = members.join(own, side, "left").withColumn(f"{side}_component", F.coalesce(f"{side}_component", side))
    members = members.select("key", "node", F.col("node_component").alias("component"), "hub_component")
    apart = members.groupBy("key").agg(F.sum((F.col("component") != F.col("hub_component")).cast("int")).alias("apart"))
    rows = stored(members.join(apart.where("apart > 0"), "key"), "mixed")
    # a member's buckets are at most as many as there are bands
    by_node = Window.partitionBy("node").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    plain = rows.where(F.col("apart") <= CROWDED).withColumn("earlier", F.collect_list("key").over(by_node)).drop("apart")
    crowded = rows.where(F.col("apart") > CROWDED).groupBy("node", "component").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    first = crowded.select("node", "component", F.posexplode("keys").alias("at", "one"), "keys")
    twice = first.select("node", "component", "one", F.explode(F.slice("keys", F.col("at") + 2, F.size("keys"))).alias("two"))
    twice = stored(twice.select(F.xxhash64("one", "two").alias("key"), "node", "component"), "refined")
    hubs = twice.groupBy("key").agg(F.min(F.struct("node", "component")).alias("hub"), F.min("component").alias("low"), F.max("component").alias("high"))
    hubs = hubs.where("low <> high").select("key", F.col("hub.component").alias("hub_component"))
    refined = twice.join(hubs, "key").withColumn("earlier", F.array().cast("array<bigint>"))
    return stored(plain.unionByName(refined), "leftover")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs`` (columns doc_id and text are read)."""
    rows = stored(sketches(docs), "sketches")
    of_class = ["fingerprint", "n_shingles", "sketch"]
    full = rows.where("doc_id is not null and fingerprint is not null")
    classes = stored(full.groupBy(*of_class).agg(F.min("doc_id").alias("node")), "classes")
    node_of = classes.select("fingerprint", "n_shingles", "node")

    bands = classes.select("node", "sketch").mapInArrow(_band_batches, "key bigint, node bigint")
    hubs = bands.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last")
    members = stored(bands.join(hubs.drop("last"), "key").distinct(), "bands")
    first = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    pairs = stored(plausible_pairs(first, classes), "pairs")
    nodes = stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "nodes")
    links = stored(verified(pairs, stored(full_sets(docs, nodes), "sets")), "links")

    # one doc_id with several texts: its classes, and its empty texts, are one document
    mark = F.when(F.col("fingerprint").isNotNull(), F.xxhash64("fingerprint")).otherwise(F.lit(0))
    marked = rows.where("doc_id is not null").select("doc_id", "fingerprint", "n_shingles", mark.alias("mark"))
    several = marked.groupBy("doc_id").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).where("low <> high")
    same = stored(marked.join(several.select("doc_id"), "doc_id").join(node_of, ["fingerprint", "n_shingles"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct(), "same")

    known = links.union(same)
    labels = components(known)
    apart = leftover(members, labels)
    sets = stored(full_sets(docs, stored(apart.select("node").distinct(), "nodes")), "sets")
    bits = stored(sets.mapInArrow(_bit_batches, ", ".join(["node bigint, n_shingles bigint", *[f"{b} bigint" for b in BITS]])), "bits")
    more = verified(stored(cross_pairs(apart, bits), "pairs"), sets)
    labels = components(stored(known.union(more), "known"))

    ids = rows.select("doc_id", "n_shingles", "fingerprint").join(node_of, ["fingerprint", "n_shingles"], "left")
    ids = ids.withColumn("node", F.coalesce("node", "doc_id")).join(labels, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
    ids = ids.select("doc_id", "n_shingles", component.alias("component_id"))
    return ids.withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay, one of each component, with their columns. Rows without doc_id all stay."""
    found = stored(near_duplicates(docs), "found").where("doc_id is not null")
    counts = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    apart = stored(counts.where("not kept or n > 1").select(F.col("doc_id").alias("_apart_id"), "kept"), "apart")
    on = docs["doc_id"].cast("bigint") == F.col("_apart_id")
    once = docs.join(_sent(apart.select("_apart_id")), on, "left_anti")
    # of rows that share a doc_id the longest text stays
    again = docs.join(_sent(apart.where("kept").select("_apart_id")), on, "left_semi")
    place, longest = free_name(docs, "_place"), Window.partitionBy("doc_id").orderBy(F.octet_length("text").desc_nulls_last(), "text")
    again = again.withColumn(place, F.row_number().over(longest)).where(F.col(place) == 1).drop(place)
    return once.unionByName(again)


def _sent(ids: DataFrame) -> DataFrame:
    """Ids of a stored table for a join: broadcast if they are few enough, else left to a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
