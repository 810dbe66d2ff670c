"""Near-duplicate documents by ProbMinHash, banding and verification.

1. Each text becomes a node: a digest of its sequence of words. Texts with the same words are one node, summed up
   before the shuffle, so a group of copies of any size is one row from here on.
2. Nodes that share a band key are a bucket. A bucket yields a star around its most central member (the one whose
   own buckets are the largest together, which for a text and its edited copies is that text; of equals, stars around
   two), and all pairs if it has at most ``SMALL`` members. The number of these pairs is linear in the number of bucket members.
3. Both texts of a pair are fetched and the probability Jaccard of their weighted shingles is computed exactly.
4. Connected components of the links of at least ``SIMILARITY`` are the first classes.
5. A star may miss links, and its centre may be the wrong one. So all pairs of a larger bucket that are in different
   classes by then are compared: the bucket is dealt into blocks of ``BLOCK`` members, and each two blocks meet in a task of
   bounded size. A pair belongs to the first bucket it shares. By the weights that both texts have in common no pair of at least
   ``SIMILARITY`` is passed over; what is left is computed exactly, the likeliest pairs first, until nothing else would join two classes.

With 32 bands of 4 registers two texts of similarity 0.8 miss each other in every band once in 2 * 10^7 pairs; of the pairs
that share a band, no link between classes is missed. Step 5 makes (members / ``BLOCK``) * members rows of a bucket that is not
one class, and its comparisons grow with the square of such a bucket; buckets of one class are done after step 4.
Texts without words are near to texts with the same bytes only. Rows are told apart by a hash of id and text; equal
rows are one document. The class id is the smallest document id of the class, null if no member has one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotweave.llm.components import components
from slotweave.llm.prob_minhash import Shingles, band_keys, probability_jaccard, shingles, signatures
from slotweave.llm.shared import written
from slotweave.llm.words import slices

SIMILARITY = 0.8
SMALL = 8
BLOCK = 512


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def signature_table(docs: DataFrame) -> DataFrame:
    """doc_id, row key, node and band keys (none for a text without words) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            s = shingles(piece.column("text"))
            keys = band_keys(signatures(s)).view(np.int64)
            filled = np.bincount(s.doc, minlength=s.n_docs) > 0
            ends = np.concatenate([[0], np.cumsum(filled * keys.shape[1])])
            bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[filled].ravel()))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("row_key"), pa.array(s.digest.view(np.int64)), bands],
                names=["doc_id", "row_key", "node", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", _row_key().alias("row_key"), "text").mapInArrow(
        run, f"doc_id {kind}, row_key long, node long, bands array<long>")


def node_table(signed: DataFrame) -> DataFrame:
    """One row per node: the first of its documents by id, and the bands."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key", "bands")).alias("first")
    return signed.groupBy("node").agg(first).select("node", "first.doc_id", "first.row_key", "first.bands")


def bucket_members(nodes: DataFrame) -> DataFrame:
    """(key, node, size) of every bucket of two and more nodes."""
    keys = nodes.select("node", F.explode("bands").alias("key"))
    return keys.join(keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key")


def candidate_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of nodes; a is a star's centre or the smaller one. ``refined`` compares the rest."""
    central = members.groupBy("node").agg(F.sum(F.col("size") - 1).alias("weight"))
    ranked = members.join(central, "node")
    # Of members that are equally central, the one with the largest and the one with the smallest node.
    centres = ranked.groupBy("key").agg(
        F.max(F.struct("weight", "node")).alias("high"),
        F.max(F.struct("weight", F.bitwise_not("node").alias("node"))).alias("low"),
    ).select("key", F.array_distinct(F.array(F.col("high.node"), F.bitwise_not("low.node"))).alias("centres"))
    star = members.join(centres, "key").select(F.explode("centres").alias("a"), F.col("node").alias("b")).where("a != b")
    small = (
        members.where(F.col("size").between(3, SMALL)).groupBy("key").agg(F.sort_array(F.collect_set("node")).alias("all"))
        .select("all", F.posexplode("all").alias("at", "a"))
        .select("a", F.explode(F.expr(f"slice(all, at + 2, {SMALL})")).alias("b"))
    )
    return star.union(small).distinct()


def mixed_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, size, node, label) of the members of buckets with more than ``SMALL`` nodes and more than one component."""
    large = members.where(F.col("size") > SMALL).join(labels, "node", "left").select(
        "key", "size", "node", F.coalesce("label", "node").alias("label"))
    mixed = large.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return large.join(mixed, "key").select("key", "size", "node", "label")


def shingle_table(mixed: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, bands, shingle, weight) of the nodes of ``mixed``: sorted shingles and their counts, as bytes."""
    wanted = mixed.select("node").distinct().join(nodes.select("node", "row_key", "bands"), "node")
    found = docs.select(_row_key().alias("row_key"), "text").join(wanted, "row_key").dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            parts = _split(shingles(piece.column("text")))
            yield pa.RecordBatch.from_arrays(
                [piece.column("node"), piece.column("bands"), pa.array([key.tobytes() for key, _ in parts], pa.binary()),
                 pa.array([count.astype(np.int32).tobytes() for _, count in parts], pa.binary())],
                names=["node", "bands", "shingle", "weight"])

    return found.select("node", "bands", "text").mapInArrow(run, "node long, bands array<long>, shingle binary, weight binary")


def _forests(near: np.ndarray, label: np.ndarray, count: int = 1) -> list[tuple[int, int]]:
    """Pairs of different labels by falling agreement, each of which joins two trees of its forest; 0 in ``near`` is no pair."""
    first, second = np.nonzero(np.triu(near, 1))
    left, out = np.argsort(-near[first, second], kind="stable").tolist(), []
    for _ in range(count):
        tree = {v: v for v in label.tolist()}
        rest = []
        for k in left:
            x, y = int(label[first[k]]), int(label[second[k]])
            while tree[x] != x:
                x = tree[x]
            while tree[y] != y:
                y = tree[y]
            if x == y:
                rest.append(k)
            else:
                tree[max(x, y)] = min(x, y)
                out.append((int(first[k]), int(second[k])))
        left = rest
    return out


def _first_shared(left: np.ndarray, right: np.ndarray, key: int) -> np.ndarray:
    """Which rows of band keys share none before the band of ``key``, which all have."""
    out = np.ones((len(left), len(right)), bool)
    for k in range(np.flatnonzero(left[0] == key)[0]):
        out &= left[:, k, None] != right[:, k]
    return out


def _likeness_bounds(left: list[tuple[np.ndarray, np.ndarray]], right: list[tuple[np.ndarray, np.ndarray]], wanted: np.ndarray) -> np.ndarray:
    """No less than the probability Jaccard of the ``wanted`` pairs, and that itself where all counts are equal.

    With u and v the shares of each text's weight that lie in common shingles it is 1 / (1 / u + 1 / v - 1): a common
    shingle adds at most the harmonic term of its two weights, and the sum of such terms is at most the term of the sums.
    """
    key, weight = (np.concatenate([text[k] for text in right]) for k in (0, 1))
    row = np.repeat(np.arange(len(right)), [len(text[0]) for text in right])
    order = np.argsort(key, kind="stable")
    key, weight, row = key[order], weight[order], row[order]
    total = np.array([text[1].sum() for text in right], np.float64)
    out = np.zeros(wanted.shape)
    for i in np.flatnonzero(wanted.any(axis=1)).tolist():
        own, count = left[i]
        first, last = np.searchsorted(key, own), np.searchsorted(key, own, "right")
        found = last - first
        at = np.repeat(first - np.cumsum(found) + found, found) + np.arange(found.sum())
        mine = np.bincount(row[at], np.repeat(count, found), len(right))
        common = np.flatnonzero(wanted[i] & (mine > 0))
        theirs = np.bincount(row[at], weight[at], len(right))
        out[i, common] = 1 / (count.sum() / mine[common] + total[common] / theirs[common] - 1)
    return out


def _joining_links(texts: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all labels between which ``near``, the bounds of pairs, allows one; each is computed exactly."""
    label, near, out = label.copy(), near.copy(), []
    while near.any():
        for x, y in _forests(near, label, 1):
            if probability_jaccard(*texts[x], *texts[y]) >= SIMILARITY - 1e-9:
                out.append((x, y))
                label[label == label[y]] = label[x]
            near[x, y] = 0
        near[label[:, None] == label] = 0
    return out


def joined_labels(mixed: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): labels that a link joins, of all pairs that share a bucket of ``mixed``."""
    count = F.ceil(F.col("size") / BLOCK).cast("long")
    own = mixed.select("key", "node", "label", count.alias("count"), F.pmod(F.xxhash64("node", "key"), count).alias("block"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1))
    met = own.select("key", "node", "label", "block", other.alias("other")).select(
        "key", "node", "label", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    def run(group: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        key, low, high = (value.as_py() for value in group)
        rows = rows.sort_by([("block", "ascending"), ("node", "ascending")])
        node, label = rows.column("node").to_numpy(), rows.column("label").to_numpy()
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        texts = [(np.frombuffer(key, np.uint64), np.frombuffer(weight, np.int32)) for key, weight in zip(
            rows.column("shingle").to_pylist(), rows.column("weight").to_pylist(), strict=True)]
        # Two blocks that meet are compared with each other alone.
        cut = len(node) if low == high else int(np.count_nonzero(rows.column("block").to_numpy() == low))
        left, right = slice(0, cut), slice(0, cut) if low == high else slice(cut, len(node))
        near = np.zeros((len(node), len(node)))
        if len(node[left]) and len(node[right]):
            wanted = _first_shared(bands[left], bands[right], key) & (label[left][:, None] != label[right])
            wanted = np.triu(wanted) if low == high else wanted
            near[left, right] = _likeness_bounds(texts[left], texts[right], wanted)
            near[near < SIMILARITY - 1e-6] = 0
        pairs = np.array(_joining_links(texts, label, near), np.int64).reshape(-1, 2)
        return pa.table({"a": label[pairs[:, 0]], "b": label[pairs[:, 1]]})

    return met.join(texts, "node").groupBy("key", "low", "high").applyInArrow(run, "a long, b long").distinct()


def refined(labels: DataFrame, nodes: DataFrame, members: DataFrame, docs: DataFrame) -> DataFrame:
    """The components with those joined that any link within a larger bucket joins."""
    mixed = written(mixed_members(members, labels), "mixed")
    if mixed.isEmpty():
        return labels
    joins = written(joined_labels(mixed, written(shingle_table(mixed, nodes, docs), "shingles")), "joins")
    if joins.isEmpty():
        return labels
    new = components(joins).select(F.col("node").alias("label"), F.col("label").alias("new"))
    # A text that no star linked is its own component.
    alone = mixed.select("node", "label").distinct().join(labels.select("node"), "node", "left_anti")
    return labels.union(alone).join(new, "label", "left").select("node", F.coalesce("new", "label").alias("label"))


def verified_links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b, similarity) whose exact similarity reaches ``SIMILARITY``."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "row_key"), "node")
    found = docs.select(_row_key().alias("row_key"), "text").join(wanted, "row_key").select("node", "text")
    texts = written(found.dropDuplicates(["node"]), "texts")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(slices(batches, "text_a"), "text_b"):
            known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for side in ("a", "b"):
                names, where = np.unique(piece.column(side).to_numpy(), return_index=True)
                s = shingles(piece.column(f"text_{side}").take(pa.array(where)))
                known.update(zip(names.tolist(), _split(s), strict=True))
            a, b = piece.column("a").to_pylist(), piece.column("b").to_pylist()
            likeness = np.array([probability_jaccard(*known[x], *known[y]) for x, y in zip(a, b, strict=True)])
            out = piece.select(["a", "b"]).append_column("similarity", pa.array(likeness, pa.float64()))
            yield out.filter(pa.array(likeness >= SIMILARITY - 1e-9))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a long, b long, similarity double")


def _split(s: Shingles) -> list[tuple[np.ndarray, np.ndarray]]:
    starts = np.searchsorted(s.doc, np.arange(s.n_docs + 1))
    return [(s.key[x:y], s.count[x:y]) for x, y in zip(starts[:-1], starts[1:], strict=True)]


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, row key, class id and whether the row is the one of its class that stays, for every document."""
    signed = written(signature_table(docs), "signed")
    nodes = written(node_table(signed), "nodes")
    members = written(bucket_members(nodes), "buckets")
    pairs = written(candidate_pairs(members), "pairs")
    labels = refined(components(written(verified_links(pairs, nodes, docs), "verified")), nodes, members, docs)
    labelled = nodes.select("node", "doc_id", "row_key").join(labels, "node", "left").select(
        "node", "doc_id", "row_key", F.coalesce("label", "node").alias("label"))
    kept = labelled.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("kept"))
    by_node = labelled.select("node", "label").join(kept, "label").select(
        "node", F.col("kept.doc_id").alias("class_id"), F.col("kept.row_key").alias("kept_key"))
    return signed.select("doc_id", "row_key", "node").join(by_node, "node").select(
        "doc_id", "row_key", "class_id", (F.col("row_key") == F.col("kept_key")).alias("stays"))


def keep_one(docs: DataFrame) -> DataFrame:
    """All columns of one document of each class: the one with the smallest id (nulls last); of equal rows, one."""
    name = "__row_key"
    while name in docs.columns:
        name += "_"
    stay = classes(docs).where("stays").select(F.col("row_key").alias(name)).distinct()
    place = F.row_number().over(Window.partitionBy(name).orderBy(name))
    return docs.withColumn(name, _row_key()).join(stay, name).withColumn(f"{name}n", place).where(
        F.col(f"{name}n") == 1).select(*(f"`{c}`" for c in docs.columns))
