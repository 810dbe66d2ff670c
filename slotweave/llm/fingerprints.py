"""Document fingerprints: a Merkle tree over sections, paragraphs and chunks, by built-in functions alone.

Sections are what stands between blank lines ("\\n\\n"), paragraphs are their lines, and a chunk is a piece of a
paragraph that ends behind ".", "!" or "?" or has 64 characters. The root is the SHA-256 of the sections' SHA-256, each
of its paragraphs', so equal roots mean equal texts. Branches carry 32 bits of their hash: enough to find the branches
in which two trees differ, and to compare their nodes. Null is an empty text, which has one empty paragraph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 64
BUCKETS_PER_PARTITION = 4
_PARAGRAPH = rf"[^.!?]{{0,{CHUNK - 1}}}(?s:.)"


def with_tree(rows: DataFrame, text: str, tree: str) -> DataFrame:
    """Append ``tree``: struct(root, sections: array of struct(hash, paragraphs: array of struct(hash, leaves)))."""
    made = (
        rows.withColumn("_hashed", F.expr(f"""
            transform(split(coalesce({text}, ''), '\\n\\n', -1), s -> transform(split(s, '\\n', -1), p -> struct(
                sha2(p, 256) as digest,
                transform(regexp_extract_all(p, r'{_PARAGRAPH}', 0), c -> hash(c)) as leaves)))"""))
        .withColumn("_sections", F.expr("transform(_hashed, s -> sha2(array_join(transform(s, p -> p.digest), ''), 256))"))
    )
    return made.withColumn(tree, F.expr("""
        struct(
            sha2(array_join(_sections, ''), 256) as root,
            zip_with(_sections, _hashed, (d, s) -> struct(
                hash(d) as hash,
                transform(s, p -> struct(hash(p.digest) as hash, p.leaves as leaves)) as paragraphs)) as sections)"""
    )).drop("_hashed", "_sections")


def rendered(tree: str) -> F.Column:
    """A tree as text: the root, then ";section" for each, ",paragraph" for each of its, and ":leaves" of that."""
    return F.expr(f"""
        concat({tree}.root, array_join(transform({tree}.sections, s -> concat(
            ';', lower(right(hex(cast(s.hash as bigint) + 4294967296), 8)),
            array_join(transform(s.paragraphs, p -> concat(
                ',', lower(right(hex(cast(p.hash as bigint) + 4294967296), 8)), ':',
                array_join(transform(p.leaves, l -> lower(right(hex(cast(l as bigint) + 4294967296), 8))), '')
            )), ''))), ''))""")


def with_nodes(rows: DataFrame, tree: str, nodes: str) -> DataFrame:
    """Append ``nodes``: the distinct hashes of a tree's sections, paragraphs and chunks."""
    return rows.withColumn(nodes, F.expr(f"""
        array_distinct(concat(
            transform({tree}.sections, s -> s.hash),
            flatten(transform({tree}.sections, s -> transform(s.paragraphs, p -> p.hash))),
            flatten(flatten(transform({tree}.sections, s -> transform(s.paragraphs, p -> p.leaves))))))"""))


def likeness(a: str, a_nodes: str, b: str, b_nodes: str) -> F.Column:
    """1 for equal roots, else the shared part of both trees' distinct nodes."""
    return F.expr(f"""
        if({a}.root = {b}.root, 1.0D,
           size(array_intersect({a_nodes}, {b_nodes})) / size(array_union({a_nodes}, {b_nodes})))""")


def differing_paragraphs(a: str, b: str) -> F.Column:
    """Where tree b differs from tree a: (section, paragraph) of b, from 0, below branches whose hashes differ.

    Equal sections are not entered. A section that a does not have at that place differs in all its paragraphs.
    """
    return F.expr(f"""
        if({a}.root = {b}.root, array(), flatten(transform({b}.sections, (s, i) ->
            if(get({a}.sections, i).hash <=> s.hash, array(),
               filter(transform(s.paragraphs, (p, j) -> if(
                   get(get({a}.sections, i).paragraphs, j).hash <=> p.hash, null, struct(i as section, j as paragraph))),
                   x -> x is not null)))))""")


def with_next(rows: DataFrame, columns: dict[str, str], buckets: int | None = None) -> DataFrame:
    """Append columns of the next row by descending ``doc_id``; after the last row comes the first.

    Ids are cut into buckets of about equal size, at approximate quantiles. Each bucket is sorted for itself, with the
    first row of the bucket that follows as its last; so no task sees more than a bucket. The driver gets the quantiles,
    whose number is a parameter; the buckets' first ids, one row each, are broadcast. Null ids come last. Rows with equal ids come in the order of their text's hash; all
    rows of one id are in one bucket.
    """
    spark = rows.sparkSession
    n = buckets or BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [k / n for k in range(1, n)]
    cut = rows.agg(F.percentile_approx("doc_id", steps, 100 * n).alias("c")).first()["c"] if steps else []
    bounds = sorted(set(cut or []), reverse=True)
    # Binary search: how many bounds are at or above the id.
    size = 1 << len(bounds).bit_length()
    steps_down = ", ".join(str(size >> k) for k in range(size.bit_length()))
    listed = f"array({', '.join(f'{b}L' for b in bounds)})" if bounds else "cast(array() as array<bigint>)"
    place = F.expr(f"""
        aggregate(array({steps_down}), 0, (at, step) ->
            if(at + step <= {len(bounds)} and get({listed}, at + step - 1) >= coalesce(doc_id, -9223372036854775808L),
               at + step, at))""")
    heads = rows.select("doc_id").withColumn("_bucket", place).groupBy("_bucket").agg(F.max("doc_id").alias("_head"))
    by_bucket = Window.orderBy("_bucket")  # over one row per bucket
    ring = heads.withColumn("_before", F.coalesce(
        F.lag("_bucket").over(by_bucket),
        F.max("_bucket").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    spread = (
        rows.withColumn("_bucket", place).join(F.broadcast(ring), "_bucket")
        .withColumn("_place", F.explode(F.expr("""
            if(doc_id <=> _head, array(struct(_bucket as bucket, false as extra), struct(_before as bucket, true as extra)),
               array(struct(_bucket as bucket, false as extra)))""")))
        .withColumn("_bucket", F.col("_place.bucket")).withColumn("_extra", F.col("_place.extra"))
        .drop("_place", "_head", "_before")
    )
    order = Window.partitionBy("_bucket").orderBy(
        "_extra", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    return spread.withColumns({new: F.lead(old).over(order) for new, old in columns.items()}).where("not _extra").drop(
        "_bucket", "_extra")


def edited_by_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next text and the text whose last third is the next one's beginning; nulls are empty texts."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    third = "cast(floor(char_length(text) / 3) as int)"
    return with_next(with_tree(texts, "text", "tree"), {"next_text": "text", "next_tree": "tree"}).withColumn(
        "edited", F.expr(f"concat(left(text, char_length(text) - {third}), left(next_text, {third}))"))
