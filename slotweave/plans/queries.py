"""The registered queries: one per operator, each over whole tables.

Arrays are returned as joined text, so that results compare by value in any engine.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotweave.functions.attributes import clean_attribute_list, distinct_texts, parse_attributes
from slotweave.functions.entities import extract_entities
from slotweave.functions.spans import (
    TAGS, apply_bioes_tags, encode_span, entity_line, exact_offset, fuzzy_offset, padded,
)
from slotweave.functions.subwords import read_vocabulary
from slotweave.functions.text import clean_text, is_brand_in_query, split_line, token_line, tokenize_query
from slotweave.operators import metrics, training_data
from slotweave.operators.alignment import aligned
from slotweave.operators.chain_tagger import ChainTagger, load_tagger, train_chain
from slotweave.operators.columns import normalize_columns
from slotweave.operators.decoding import SLOT_COLUMNS, decode_slots, leaderboard
from slotweave.operators.labeling import label_queries
from slotweave.operators.spread import spread
from slotweave.operators.sql_functions import register_sql_functions
from slotweave.operators.tagger import Tagger, train_tagger
from slotweave.plans import evaluate_job
from slotweave.plans.evaluate_job import predict_slots
from slotweave.plans.label_job import job_counters, label_table, run_stream
from slotweave.plans.query_log import query_log
from slotweave.plans.scratch import scratch_path
from slotweave.plans.train_job import validation_report
from slotweave.sources import readers, writers
from slotweave.streaming.label_stream import label_stream, query_stream


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return query_log(spark, _table(spark, folder, "part"))


def _labelled(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    return label_queries(_log(spark, folder), keep=("query_id", *keep))


def _joined(array: Column | str, separator: str = "|") -> Column:
    return F.array_join(array, separator)


def _flat(labelled: DataFrame, *keep: str) -> DataFrame:
    """Labelled rows with their arrays as text."""
    return labelled.select(
        *keep, "query", "brand", _joined("attributes").alias("attributes"), "product_type",
        _joined("tokens", " ").alias("tokens"), _joined("bioes_tags", " ").alias("bioes_tags"),
        "augmented_query", "brand_added",
    )


def tag_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """How many tokens each tag covers."""
    tags = label_queries(_log(spark, folder), outputs=("bioes_tags",))
    return tags.select(F.explode("bioes_tags").alias("tag")).groupBy("tag").agg(
        F.count(F.lit(1)).alias("n_tokens")
    )


# Text (B)


def clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", clean_text(F.col("text")).alias("cleaned"))


def tokenize_conversations(spark: SparkSession, folder: str) -> DataFrame:
    tokens = _table(spark, folder, "conversations").select(
        "conv_id", "turn", tokenize_query(F.col("text")).alias("tokens")
    )
    return tokens.select(
        "conv_id", "turn", _joined("tokens", " ").alias("tokens"), F.size("tokens").cast("bigint").alias("n_tokens")
    )


def brand_in_query(spark: SparkSession, folder: str) -> DataFrame:
    return _log(spark, folder).select("query_id", is_brand_in_query(F.col("brand"), F.col("query")).alias("found"))


def _parsed(rows: DataFrame, key: str, text: Column) -> DataFrame:
    return rows.select(key, _joined(parse_attributes(text)).alias("attributes"))


def parse_attribute_mix(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(_log(spark, folder), "query_id", F.col("attributes"))


JSON_LIST_SQL = """concat('["', p_name, '", ', cast(p_size as string), ', null, 0, "0", "", true, false, ', case when p_size % 2 = 0 then '1.5e3' else '[]' end, ', "', p_name, '", "', p_type, '"]')"""
REPEATED_KEYS_SQL = """concat('{"a": "', p_brand, '", "b": ', cast(p_size - 1 as string), ', "', case when p_size % 2 = 0 then 'a' else 'c' end, '": "', p_name, '"}')"""
REQUOTED_SQL = """case when p_size % 3 = 0 then concat('{''a'': ''', p_name, ''', ''b'': ', cast(p_size as string), '}') when p_size % 3 = 1 then concat('[''', p_name, ''', ''', p_type, ''']') else concat('''', p_name, '''') end"""
LOOSE_SQL = """case when p_size % 4 = 0 then concat('(', p_name, ')(', p_type, ')') when p_size % 4 = 1 then concat('[', p_name, ', ', p_type, ']') when p_size % 4 = 2 then concat(p_name, ', ', p_type, ', ', p_name) else concat('[''', p_name, '''s'', "', p_type, '"]') end"""


def parse_json_lists(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(_table(spark, folder, "part"), "p_partkey", F.expr(JSON_LIST_SQL))


def parse_event_objects(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(_table(spark, folder, "events"), "event_id", F.col("props"))


def parse_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(_table(spark, folder, "part"), "p_partkey", F.expr(REPEATED_KEYS_SQL))


def parse_requoted_json(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(_table(spark, folder, "part"), "p_partkey", F.expr(REQUOTED_SQL))


def parse_loose_lists(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(_table(spark, folder, "part"), "p_partkey", F.expr(LOOSE_SQL))


def parse_loose_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as attribute texts."""
    return _parsed(_table(spark, folder, "documents"), "doc_id", F.col("text"))


def dedupe_document_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "documents").select("doc_id", distinct_texts(F.split("text", "\n")).alias("lines"))
    return lines.select("doc_id", _joined("lines").alias("lines"), F.size("lines").cast("bigint").alias("n_lines"))


def clean_native_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation lines as native lists: repeats and blank items stay."""
    items = F.split(F.concat(F.col("text"), F.lit("\n \n\n"), F.col("role")), "\n")
    cleaned = _table(spark, folder, "conversations").select("conv_id", "turn", clean_attribute_list(items).alias("items"))
    return cleaned.select(
        "conv_id", "turn", _joined("items").alias("items"), F.size("items").cast("bigint").alias("n_items")
    )


# Tagging (C)


def _document_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as token lines, and three words from the middle of each, in capitals."""
    lines = _table(spark, folder, "documents").select("doc_id", token_line(clean_text(F.col("text"))).alias("line"))
    tokens = lines.select("doc_id", "line", split_line(F.col("line")).alias("tokens"))
    middle = F.floor(F.size("tokens") / 2).cast("int")
    return tokens.select("*", F.transform(F.slice("tokens", middle + 1, F.lit(5)), F.lower).alias("words"))


def exact_span(spark: SparkSession, folder: str) -> DataFrame:
    """First place of three words from the middle of each document."""
    rows = _document_tokens(spark, folder).select(
        "doc_id", padded(F.col("line")).alias("marked"),
        padded(F.upper(_joined(F.slice("words", 1, 3), " "))).alias("entity"),
    )
    return rows.select("doc_id", exact_offset(F.col("marked"), F.col("entity")).cast("bigint").alias("span_start"))


def fuzzy_span(spark: SparkSession, folder: str) -> DataFrame:
    """First place of five words from the middle of each document, the third one changed."""
    words = F.transform("words", lambda word, k: F.when(k == 2, F.lit("#changed#")).otherwise(word))
    rows = _document_tokens(spark, folder).select(
        "doc_id", F.transform("tokens", F.lower).alias("cells"), words.alias("words")
    )
    place = F.when(F.size("words") == 5, fuzzy_offset(F.col("cells"), F.col("words")))
    return rows.select("doc_id", place.cast("bigint").alias("span_start"))


def span_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").select(
        "p_partkey", _joined(encode_span(F.col("p_size"), "Attribute"), " ").alias("tags")
    )


def priority_fold(spark: SparkSession, folder: str) -> DataFrame:
    """Product type before brand before first attribute: another order than the labeller's."""
    rows = _log(spark, folder).select(
        "query_id", tokenize_query(F.col("query")).alias("tokens"), clean_text(F.col("product_type")).alias("type"),
        clean_text(F.col("brand")).alias("brand"), clean_text(F.col("true_attr1")).alias("attribute"),
    )
    rows = rows.select("*", F.transform("tokens", lambda _: F.lit("O")).alias("tags"))
    for column, label in (("type", "ProductType"), ("brand", "Brand"), ("attribute", "Attribute")):
        tags = apply_bioes_tags(F.col("tokens"), F.col("tags"), F.col(column), label)
        rows = rows.select("query_id", "tokens", "type", "brand", "attribute", tags.alias("tags"))
    return rows.select("query_id", _joined("tags", " ").alias("tags"))


def augment_brand(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder).select("query_id", "augmented_query", "brand_added")


def label_query_log(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_labelled(spark, folder), "query_id")


def _sql_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The query log labelled in SQL, by functions of this session."""
    register_sql_functions(spark)
    return spark.sql("""
        SELECT query_id, query, brand, attributes, product_type, inline(array(labels))
        FROM (
            SELECT query_id, clean_text(query) AS query, clean_text(brand) AS brand, attributes, clean_text(product_type) AS product_type,
                   label_query(query, brand, attributes, product_type) AS labels
            FROM (SELECT query_id, query, brand, product_type, parse_attributes(attributes) AS attributes FROM {log}))
    """, log=_log(spark, folder))


def sql_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_sql_labels(spark, folder), "query_id")


def sql_slots(spark: SparkSession, folder: str) -> DataFrame:
    """Slots decoded in SQL from the labels that SQL gave."""
    return spark.sql("""
        SELECT query_id, slots.brand_pred, array_join(slots.attributes_pred, '|') AS attributes_pred, slots.product_type_pred
        FROM (SELECT query_id, predicted_slots(extract_entities(tokens, bioes_tags)) AS slots FROM {labels})
    """, labels=_sql_labels(spark, folder))


def _labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as queries; their own first, middle and last words as slot values."""
    documents = spread(_table(spark, folder, "documents").select("doc_id", "text", "source"))
    words = F.split(F.trim(F.regexp_replace("text", r"[ \n]+", " ")), " ")
    middle = F.floor(F.size("words") / 2).cast("int")
    rows = documents.select("doc_id", F.col("text").alias("query"), "source", words.alias("words"))
    queries = rows.select(
        "doc_id", "query", F.col("source").alias("brand"),
        F.array(F.get("words", middle), _joined(F.slice("words", 1, 2), " ")).alias("attributes"),
        F.element_at("words", -1).alias("product_type"),
    )
    return label_queries(queries, keep=("doc_id",))


def label_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled_documents(spark, folder).select(
        "doc_id", _joined("bioes_tags", " ").alias("bioes_tags"), F.size("tokens").cast("bigint").alias("n_tokens"),
        "brand_added",
    )


def error_capture(spark: SparkSession, folder: str) -> DataFrame:
    """CSV rows with a cell too many are kept, without tags."""
    path = scratch_path(spark)
    cells = F.concat_ws(
        ",", F.col("query_id").cast("string"), F.col("product_type"), F.coalesce("brand", F.lit("")),
        F.when(F.col("query_id") % 10 == 0, F.lit("one,two")).otherwise("one"),
    )
    _log(spark, folder).select(cells.alias("value")).write.text(path)
    raw = readers.read_headless_csv(spark, path, ["query", "product_type", "brand", "extra"])
    labelled = label_queries(raw)
    return labelled.select(
        F.col("query").cast("bigint").alias("query_id"), F.col("error").isNotNull().alias("failed"),
        F.size("tokens").cast("bigint").alias("n_tokens"), "brand_added",
    )


def label_job(spark: SparkSession, folder: str) -> DataFrame:
    """The batch job into CSV, read back and counted by product type."""
    path = f"{scratch_path(spark)}/labelled.csv"
    label_table(_log(spark, folder), path)
    return readers.read_labelled(spark, path).groupBy("product_type").agg(
        F.count(F.lit(1)).alias("n_queries"), F.sum(F.size("tokens")).alias("n_tokens"),
        F.count_if("brand_added").alias("n_brand_added"),
    )


# Decoding (D)


def decode_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Entities of rows whose tags are mostly malformed: tags are drawn from lengths and places."""
    names = F.array(*(F.lit(tag) for tag in TAGS))
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", tokenize_query(F.col("text")).alias("tokens"))
    drawn = F.transform(
        "tokens", lambda token, k: F.get(names, ((F.length(token) * 7 + k * k + k) % len(TAGS)).cast("int"))
    )
    entities = rows.select("conv_id", "turn", extract_entities(F.col("tokens"), drawn).alias("e"))
    return entities.select("conv_id", "turn", *(_joined(f"e.{label}").alias(label.lower()) for label in ("Brand", "Attribute", "ProductType")))


def slot_projection(spark: SparkSession, folder: str) -> DataFrame:
    return decode_slots(_labelled(spark, folder)).select(
        "query_id", "brand_pred", _joined("attributes_pred").alias("attributes_pred"), "product_type_pred"
    )


# Evaluation (E)


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The query log with its true slots and the predicted ones, in the same rows."""
    log = _log(spark, folder)
    decoded = decode_slots(label_queries(log.select(F.struct("*").alias("_row"), *log.columns), keep=("_row",)))
    truth = F.array("_row.true_attr1", "_row.true_attr2")
    return decoded.select(
        "_row.query_id", "_row.query", "_row.brand", "_row.product_type", truth.alias("attributes"), *SLOT_COLUMNS
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(name, 6).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes))


def top1_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    df = _predictions(spark, folder)
    return _rounded(df.groupBy("brand").agg(metrics.top1_accuracy(df)))


def single_slot_scores(spark: SparkSession, folder: str) -> DataFrame:
    df = _predictions(spark, folder)
    scores = [column for slot in metrics.SINGLE_SLOTS for column in metrics.single_slot_scores(df, *slot)]
    return _rounded(df.groupBy("product_type").agg(*scores))


def list_slot_scores(spark: SparkSession, folder: str) -> DataFrame:
    df = _predictions(spark, folder)
    return _rounded(df.groupBy("product_type").agg(*metrics.list_slot_scores(df, *metrics.LIST_SLOT)))


def row_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Truth and prediction side by side, as the evaluation job lays them out."""
    log = _log(spark, folder)
    test = log.withColumn("attributes", F.concat(F.lit("['"), "true_attr1", F.lit("', '"), "true_attr2", F.lit("']")))
    return predict_slots(test).select(
        "query_id", "brand", "brand_pred", _joined("attributes").alias("attributes"),
        _joined("attributes_pred").alias("attributes_pred"), "product_type", "product_type_pred",
    )


def aligned_files(spark: SparkSession, folder: str) -> DataFrame:
    """Truth and prediction from two tables of files without a common key: rows meet by their place."""
    path = scratch_path(spark)
    row_alignment(spark, folder).write.parquet(f"{path}/both")
    both = spark.read.parquet(f"{path}/both")
    truth = both.select("query_id", "brand", "attributes", "product_type").repartitionByRange(5, "query_id").sortWithinPartitions("query_id")
    found = both.repartitionByRange(3, "query_id").sortWithinPartitions("query_id").select("brand_pred", "attributes_pred", "product_type_pred")
    truth.write.parquet(f"{path}/truth.parquet")
    found.write.parquet(f"{path}/found.parquet")
    return aligned(*(readers.read_in_order(spark, f"{path}/{name}.parquet") for name in ("truth", "found")))


def metric_pack(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.slot_metrics(_predictions(spark, folder)))


def entity_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.entity_metrics(_predictions(spark, folder)))


def report_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Report of one label against another over the labelled documents."""
    report = metrics.classification_report(_table(spark, folder, "labels"), "quality", "toxic")
    return _rounded(report.drop("position"))


def report_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Report of the tags found without attributes against all tags; both label the appended brands."""
    log = _log(spark, folder)
    plain = label_queries(
        log.select("query_id", "query", "brand", "product_type", F.struct("*").alias("_row")), keep=("_row", "query_id")
    ).select("_row.*", F.col("bioes_tags").alias("predicted"))
    full = label_queries(plain, keep=("predicted",))
    pairs = metrics.tag_pairs(full, "bioes_tags", "predicted")
    return _rounded(metrics.classification_report(pairs).drop("position"))


def drop_ignored(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of labels that count, with every third position marked as ignored."""
    rows = _labelled(spark, folder)
    labels = F.transform("bioes_tags", lambda tag, k: F.when(k % 3 == 2, -100).otherwise(F.length(tag)))
    kept = rows.select("query_id", metrics.drop_ignored(labels, F.transform("tokens", F.length)).alias("pairs"))
    return kept.select(
        "query_id", F.size("pairs").cast("bigint").alias("n_pairs"),
        _joined(F.transform("pairs", lambda p: F.concat_ws(":", p["label"], p["prediction"])), " ").alias("pairs"),
    )


def decode_ids(spark: SparkSession, folder: str) -> DataFrame:
    """All tags to ids and back."""
    vocabulary = training_data.closed_vocabulary(spark)
    ids = training_data.encode_tags(_labelled(spark, folder), vocabulary).select("query_id", "tag_ids")
    decoded = training_data.decode_tags(ids, vocabulary)
    return decoded.select("query_id", _joined("tag_ids", " ").alias("tag_ids"), _joined("bioes_tags", " ").alias("tags"))


# Training (F)


def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Documents on each side of the split, by language."""
    documents = _table(spark, folder, "documents")
    training, validation = training_data.train_validation_split(documents, keys=("doc_id",), seed=7)
    sides = training.select("lang", F.lit("train").alias("side")).unionAll(
        validation.select("lang", F.lit("validation").alias("side"))
    )
    return sides.groupBy("lang", "side").agg(F.count(F.lit(1)).alias("n_rows"))


def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Tag vocabulary of the training side; the raw queries are split, so one side alone is labelled."""
    training, _ = training_data.train_validation_split(_log(spark, folder))
    return training_data.tag_vocabulary(label_queries(training))


def align_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of the sub-tokens of documents, each word cut into pieces of four characters; and how many are cut off."""
    ids = training_data.encode_tags(_labelled_documents(spark, folder), training_data.closed_vocabulary(spark))
    pieces = F.flatten(F.transform(
        "tokens", lambda token, k: F.array_repeat(k, F.ceil(F.length(token) / 4).cast("int"))
    ))
    special = F.array(F.lit(None).cast("int"))
    rows = ids.select("doc_id", "tag_ids", F.concat(special, pieces, special).alias("word_ids"))
    aligned = training_data.align_labels(F.col("word_ids"), F.col("tag_ids"))
    cut = F.greatest(F.size("word_ids") - training_data.MAX_LENGTH, F.lit(0)).cast("bigint")
    return rows.select("doc_id", _joined(aligned, " ").alias("labels"), cut.alias("n_cut"))


def subword_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """Ids, mask and labels of the sub-words of whole documents, by longest match in a public vocabulary."""
    vocabulary = read_vocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))
    ids = training_data.encode_tags(_labelled_documents(spark, folder), training_data.closed_vocabulary(spark))
    inputs = training_data.model_inputs(ids.select("doc_id", "tokens", "tag_ids"), vocabulary)
    return inputs.select(
        "doc_id", _joined("input_ids", " ").alias("input_ids"), _joined("labels", " ").alias("labels"),
        F.aggregate("attention_mask", F.lit(0), lambda a, b: a + b).cast("bigint").alias("n_used"), "n_pieces",
        F.md5(_joined(F.transform("word_ids", lambda w: F.coalesce(w, F.lit(-1))), " ")).alias("words_digest"))


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Labelled queries of both sides of the split, written once: the fit passes over its side many times."""
    path = scratch_path(spark)
    log = spread(_log(spark, folder))
    side = F.when(training_data.split_bucket([F.col("query")]) < 20, "validation").otherwise("training")
    label_queries(log.withColumn("_side", side), keep=("query_id", "_side")).write.partitionBy("_side").parquet(path)
    labelled = spark.read.parquet(path)
    return labelled.where("_side = 'training'"), labelled.where("_side = 'validation'")


def train_and_report(spark: SparkSession, folder: str) -> DataFrame:
    """Fit a tagger and report on the queries it has not seen.

    ``found`` says that a tag with a tenth of the tokens or more reaches an F1 of 0.5; it is true for rarer tags.
    """
    training, validation = _sides(spark, folder)
    report = validation_report(train_tagger(training, max_iter=15), validation)
    total = F.max(F.when(F.col("label") == "accuracy", F.col("support"))).over(Window.partitionBy(F.lit(0)))
    known = report.select("label", "support", "f1", total.alias("total")).where(F.col("label").isin(*TAGS) & (F.col("support") > 0))
    return known.select("label", "support", ((F.col("f1") >= 0.5) | (10 * F.col("support") < F.col("total"))).alias("found"))


def tag_unseen(spark: SparkSession, folder: str) -> DataFrame:
    """Tag the raw validation queries by a tagger and by the same one saved and loaded."""
    path = scratch_path(spark)
    training, validation = _sides(spark, folder)
    tagger = train_tagger(training, max_iter=15)
    tagger.save(path)
    tagged = tagger.tag_queries(validation.select("query_id", "query")).withColumnRenamed("bioes_tags", "first_tags")
    both = Tagger.load(path).tag_tokens(tagged)
    known = F.array(*(F.lit(tag) for tag in TAGS))
    return both.select(
        "query_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.size("bioes_tags").cast("bigint").alias("n_tags"),
        F.forall("bioes_tags", lambda tag: F.array_contains(known, tag)).alias("all_known"),
        (F.col("first_tags") == F.col("bioes_tags")).alias("same_after_loading"),
    )


def _chain(spark: SparkSession, training: DataFrame) -> ChainTagger:
    """A chain tagger; a tenth of the training queries chooses the pass."""
    rest, chosen = training_data.train_validation_split(training, percent=10, seed=1)
    return train_chain(rest, scratch_path(spark), chosen, passes=10)


def chain_report(spark: SparkSession, folder: str) -> DataFrame:
    """Precision, recall and F1 on unseen queries, per tag and of whole spans, of the independent and the chain tagger."""
    training, validation = _sides(spark, folder)
    reports = []
    for model, tagger in (("independent", train_tagger(training, max_iter=15)), ("chain", _chain(spark, training))):
        tagged = tagger.tag_tokens(validation.select("tokens", "bioes_tags"), output="predicted")
        spans = metrics.span_report(tagged, "bioes_tags", "predicted").select(F.lit("span").alias("label"), "precision", "recall", "f1", "support")
        tags = validation_report(tagger, validation).select("label", "precision", "recall", "f1", "support")
        reports.append(tags.unionByName(spans).select(F.lit(model).alias("model"), "*"))
    return reports[0].unionByName(reports[1])


def chain_unseen(spark: SparkSession, folder: str) -> DataFrame:
    """Tags and slots of unseen raw queries by the chain tagger; none of them breaks the BIOES rules."""
    path = scratch_path(spark)
    training, validation = _sides(spark, folder)
    _chain(spark, training).save(path)
    tagged = load_tagger(path).tag_queries(validation.select("query_id", "query"))
    return decode_slots(tagged).select(
        "query_id", "query", _joined("tokens", " ").alias("tokens"), _joined("bioes_tags", " ").alias("bioes_tags"),
        "brand_pred", _joined("attributes_pred").alias("attributes_pred"), "product_type_pred")


# Sources and sinks (A)


def _written_log(spark: SparkSession, folder: str, fmt: str) -> str:
    """The query log, with line breaks in the queries, written for a source to read."""
    path = f"{scratch_path(spark)}/log.{fmt}"
    log = _log(spark, folder).withColumn("query", F.replace("query", F.lit(" "), F.lit("\n")))
    writers.write_table(log, path, fmt)
    return path


def csv_source(spark: SparkSession, folder: str) -> DataFrame:
    df = readers.read_queries(spark, _written_log(spark, folder, "csv"))
    return df.select(F.col("query_id").cast("bigint").alias("query_id"), "query", "brand", "attributes", "product_type")


def csv_split(spark: SparkSession, folder: str) -> DataFrame:
    """The query log, with line breaks and quotes in its cells, from one CSV file that many tasks read."""
    path = f"{scratch_path(spark)}/log.csv"
    log = _log(spark, folder).withColumn("query", F.replace("query", F.lit(" "), F.lit('\n"')))
    writers.write_table(log.coalesce(1), path)
    df = readers.read_queries(spark, path, by_name=True)
    return df.select(F.col("query_id").cast("bigint").alias("query_id"), "query", "brand", "attributes", "product_type")


def csv_headers(spark: SparkSession, folder: str) -> DataFrame:
    """The query log from files that differ in the order and names of their columns, one of them not in UTF-8."""
    path = scratch_path(spark)
    log = _log(spark, folder).withColumns({"Brand": "brand", "extra": F.lit("é")})
    orders = (("query_id", "query", "brand", "attributes", "product_type"), ("product_type", "Query", "query_id", "attributes", "Brand", "extra"),
              ("attributes", "query_id", "Product_type", "query"))
    for number, names in enumerate(orders):
        rows = log.where(F.pmod("query_id", F.lit(3)) == number).select(*(F.col(name).alias(name) for name in names))
        rows.write.options(**writers.CSV_OPTIONS, encoding="ISO-8859-1" if number == 1 else "UTF-8").mode("append").csv(f"{path}/log.csv")
    df = readers.read_queries(spark, f"{path}/log.csv", by_name=True)
    return df.select(F.col("query_id").cast("bigint").alias("query_id"), "query", "brand", "attributes", "product_type", "extra", "error")


def _json_lines(spark: SparkSession, folder: str, malformed: bool) -> str:
    """The query log as JSON lines in several files: attributes are a list in one row and text in the next."""
    path = f"{scratch_path(spark)}/log.json"
    log = _log(spark, folder).select("query_id", "query", "brand", F.col("product_type").alias("Product_type"), "attributes")
    items = F.when(F.col("brand").isNull(), F.to_json(F.array("query"))).otherwise(F.to_json(F.array("brand", "query")))
    listed = F.concat(F.substring(items, F.lit(1), F.length(items) - 1), F.lit(', 1.0, 2.50, 1e3, ["x", 1]]'))
    head = F.to_json(F.struct("query_id", "query", "brand", "Product_type"))
    # The attributes as a JSON string: the only item of a list, without its brackets.
    single = F.to_json(F.array("attributes"))
    attributes = F.when(F.col("query_id") % 2 == 0, listed).otherwise(F.substring(single, F.lit(2), F.length(single) - 2))
    line = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(', "attributes": '), attributes, F.lit("}"))
    if malformed:
        line = F.when(F.col("query_id") % 10 == 0, F.concat(F.lit("{"), line)).otherwise(line)
    log.select(line.alias("value")).repartition(4, "value").write.text(path)
    return path


def json_source(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines whose attributes are a list, with numbers and a list in it, in one row and text in the next."""
    rows = readers.read_queries(spark, _json_lines(spark, folder, malformed=False))
    return _flat(label_queries(rows, keep=("query_id",)), F.col("query_id").cast("bigint").alias("query_id")).select(
        "query_id", "query", "brand", "product_type", "attributes")


def json_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The records of ``json_source`` from four files that hold one list each, which many tasks read."""
    path = f"{scratch_path(spark)}/documents.json"
    lines = spark.read.text(_json_lines(spark, folder, malformed=False)).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(4)))
    in_file = Window.partitionBy("part")
    place = F.row_number().over(in_file.orderBy("value"))
    text = F.concat(
        F.when(place == 1, "[ ").otherwise(", "), "value", F.when(place == F.count(F.lit(1)).over(in_file), " ]").otherwise(""))
    lines.select("part", text.alias("text")).write.partitionBy("part").text(path)
    rows = readers.read_queries(spark, path, whole_document=True, further=("query_id",))
    return _flat(label_queries(rows, keep=("query_id",)), F.col("query_id").cast("bigint").alias("query_id")).select(
        "query_id", "query", "brand", "product_type", "attributes")


def column_names(spark: SparkSession, folder: str) -> DataFrame:
    """Alternate names are read, missing columns become ''."""
    part = _table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("Query"), F.col("p_size").alias("brand"))
    return normalize_columns(part, keep=("p_partkey",))


def missing_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Cells that mean "missing": every part type is replaced by one of them, or by none."""
    cells = F.array(*(F.lit(text) for text in (*readers.MISSING_TEXTS, "nil", "none", "0")))
    part = _table(spark, folder, "part").select("p_partkey", F.get(cells, (F.col("p_partkey") % 22).cast("int")).alias("cell"))
    return part.select("p_partkey", readers.missing_to_null(F.col("cell")).alias("cell"))


def stream_labelling(spark: SparkSession, folder: str) -> DataFrame:
    """The query log as a stream of files, labelled and appended; then read as a table."""
    path = scratch_path(spark)
    schema = _table(spark, folder, "part").schema
    stream = query_stream(spark, folder, schema, max_files_per_trigger=1, pathGlobFilter="part.parquet")
    query = label_stream(
        query_log(spark, stream), f"{path}/labelled", f"{path}/checkpoint", "parquet", keep=("query_id",)
    )
    query.awaitTermination()
    return _flat(spark.read.parquet(f"{path}/labelled"), "query_id", "error")


def _streamed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """A stream labelled in micro-batches and appended; then all nine columns as a table."""
    path = scratch_path(spark)
    label_stream(rows, f"{path}/labelled", f"{path}/checkpoint", "parquet", keep=("query_id",)).awaitTermination()
    labelled = spark.read.parquet(f"{path}/labelled")
    return _flat(labelled, F.col("query_id").cast("bigint").alias("query_id"), F.col("error").isNotNull().alias("failed"))


def _csv_lines(spark: SparkSession, folder: str) -> str:
    """The query log as CSV in several files with headers; every tenth row has a cell too many."""
    path = f"{scratch_path(spark)}/log.csv"
    names = ("query_id", "query", "brand", "attributes", "product_type")
    cells = [F.coalesce(F.concat(F.lit('"'), F.replace(F.col(name).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for name in names]
    more = F.when(F.col("query_id") % 10 == 0, F.lit(",surplus")).otherwise("")
    lines = _log(spark, folder).select(F.concat(F.concat_ws(",", *cells), more).alias(",".join(names)))
    lines.repartition(4, F.col(f"`{lines.columns[0]}`")).write.options(
        header=True, sep="\x01", quote="", escape="").csv(path)
    return path


def stream_csv(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files as a stream, one file a micro-batch, malformed rows among them."""
    return _streamed(spark, readers.read_csv(spark, _csv_lines(spark, folder), stream=True, maxFilesPerTrigger=1))


def csv_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The same files as a table."""
    rows = readers.read_csv(spark, _csv_lines(spark, folder))
    return _flat(label_queries(rows, keep=("query_id",)), F.col("query_id").cast("bigint").alias("query_id"),
                 F.col("error").isNotNull().alias("failed"))


def stream_json(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines as a stream, one file a micro-batch, lines among them that are not JSON."""
    path = _json_lines(spark, folder, malformed=True)
    return _streamed(spark, readers.read_json(spark, path, stream=True, further=("query_id",), maxFilesPerTrigger=1))


def evaluated_failures(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluation job on CSV with malformed rows, which are counted but not scored."""
    path = f"{scratch_path(spark)}/test.csv"
    log = _log(spark, folder)
    literal = F.concat(F.lit("['"), "true_attr1", F.lit("', '"), "true_attr2", F.lit("']"))
    names = ("query_id", "query", "brand", "attributes", "product_type")
    cells = [F.coalesce(F.concat(F.lit('"'), F.col(name).cast("string"), F.lit('"')), F.lit("")) for name in names]
    more = F.when(F.col("query_id") % 10 == 0, F.lit(",surplus")).otherwise("")
    log.withColumn("attributes", literal).select(F.concat(F.concat_ws(",", *cells), more).alias(",".join(names))).write.options(
        header=True, sep="\x01", quote="", escape="").csv(path)
    target = scratch_path(spark)
    evaluate_job.run(spark, path, target)
    scores, counts = (spark.read.json(f"{target}/{name}.json") for name in ("metrics", "counters"))
    return _rounded(scores.withColumns({name: counts.select(name).scalar() for name in ("rows_read", "errors")}))


def _round_trip(spark: SparkSession, folder: str, fmt: str) -> DataFrame:
    """Labelled rows with their key, written and read back: all nine columns."""
    path = f"{scratch_path(spark)}/labelled.{fmt}"
    writers.write_table(_labelled(spark, folder), path)
    back = readers.read_labelled(spark, path, more="query_id bigint")
    return _flat(back, F.col("query_id").cast("bigint").alias("query_id"), "error")


def csv_sink(spark: SparkSession, folder: str) -> DataFrame:
    df = _round_trip(spark, folder, "csv")
    texts = ("query", "brand", "product_type", "augmented_query")
    return df.withColumns({name: F.coalesce(name, F.lit("")) for name in texts})


def json_sink(spark: SparkSession, folder: str) -> DataFrame:
    return _round_trip(spark, folder, "json")


def read_list_literals(spark: SparkSession, folder: str) -> DataFrame:
    """List columns in Python notation, with both kinds of quotes, as arrays again."""
    tokens = tokenize_query(F.col("text"))
    quoted = F.transform(tokens, lambda t: F.when(
        F.contains(t, F.lit("'")), F.concat(F.lit('"'), t, F.lit('"'))
    ).otherwise(F.concat(F.lit("'"), F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit("'"))))
    literal = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", readers.parse_list_text(literal).alias("tokens"))
    return rows.select("conv_id", "turn", F.size("tokens").cast("bigint").alias("n_tokens"), F.md5(_joined("tokens", " ")).alias("digest"))


def metrics_sink(spark: SparkSession, folder: str) -> DataFrame:
    """The metric pack of the predictions by row alignment, written and read back."""
    path = f"{scratch_path(spark)}/metrics.json"
    df = _predictions(spark, folder).withColumn("brand", F.coalesce("brand", F.lit("")))
    writers.write_metrics(metrics.slot_metrics(df), path)
    return _rounded(spark.read.json(path))


def predictions_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_path(spark)}/predictions.csv"
    writers.write_predictions(_predictions(spark, folder), path)
    df = readers.read_labelled(spark, path)
    return df.select(
        F.col("query_id").cast("bigint").alias("query_id"), "query", "brand", "product_type",
        _joined("attributes").alias("attributes"), F.coalesce("brand_pred", F.lit("")).alias("brand_pred"),
        _joined("attributes_pred").alias("attributes_pred"), F.coalesce("product_type_pred", F.lit("")).alias("product_type_pred"),
    )


def leaderboard_sink(spark: SparkSession, folder: str) -> DataFrame:
    """The submission table, written and read back; the key goes along to compare row by row."""
    path = f"{scratch_path(spark)}/leaderboard.csv"
    writers.write_leaderboard(_predictions(spark, folder), path, keep=("query_id",))
    board = spark.read.options(**writers.CSV_OPTIONS).csv(path)
    return board.select(
        F.col("query_id").cast("bigint").alias("query_id"), "query",
        *(F.coalesce(name, F.lit("")).alias(name) for name in ("brand", "product_type", "attributes")),
        _joined(readers.parse_list_text(F.col("attributes_pred"))).alias("attributes_pred"),
    )


def checked_source(spark: SparkSession, folder: str) -> DataFrame:
    """A source that is checked for its format and for rows."""
    return readers.read_queries(spark, f"{folder}/part.parquet").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_parts"))


def counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of a labelling run over whole documents, each with a blank row beside it."""
    documents = spread(_table(spark, folder, "documents").select("text", "source")).select(
        F.explode(F.array("text", F.lit(" "))).alias("query"), F.col("source").alias("brand")
    )
    return label_queries(documents).agg(*job_counters())


def stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of a stream over whole documents, each with a blank row beside it, in several runs of several batches.

    A batch takes one file for each core; rows are dealt in turn, so that the blank ones do not make up one file.
    """
    path, cores = scratch_path(spark), spark.sparkContext.defaultParallelism
    documents = _table(spark, folder, "documents").select(
        "doc_id", F.explode(F.array("text", F.lit(" "))).alias("query"), F.col("source").alias("brand"))
    runs = []
    for part in range(2):
        rows = documents.where(F.pmod("doc_id", F.lit(2)) == part).drop("doc_id")
        rows.repartition(4 * cores).write.mode("append").parquet(f"{path}/source.parquet")
        runs.append(run_stream(spark, f"{path}/source.parquet", f"{path}/labelled.parquet", f"{path}/checkpoint", maxFilesPerTrigger=cores))
    names = list(runs[0])
    totals = spark.createDataFrame([[run[name] for name in names] for run in runs], ", ".join(f"{name} bigint" for name in names))
    return totals.agg(*(F.sum(name).alias(name) for name in names))


QUERIES = {
    "tag_distribution": tag_distribution,
    "A1_csv_source": csv_source,
    "A2_json_source": json_source,
    "A2_json_documents": json_documents,
    "A3_column_names": column_names,
    "A4_missing_texts": missing_texts,
    "A1_csv_folder": csv_folder,
    "A1_csv_split": csv_split,
    "A1_csv_headers": csv_headers,
    "A5_stream_labelling": stream_labelling,
    "A5_stream_csv": stream_csv,
    "A5_stream_json": stream_json,
    "A6_csv_sink": csv_sink,
    "A7_json_sink": json_sink,
    "A8_read_list_literals": read_list_literals,
    "A9_metrics_sink": metrics_sink,
    "A10_predictions_sink": predictions_sink,
    "A11_leaderboard_sink": leaderboard_sink,
    "A13_checked_source": checked_source,
    "B1_clean_documents": clean_documents,
    "B2_tokenize_conversations": tokenize_conversations,
    "B3_parse_attribute_mix": parse_attribute_mix,
    "B3a_parse_json_lists": parse_json_lists,
    "B3b_parse_event_objects": parse_event_objects,
    "B3b_parse_repeated_keys": parse_repeated_keys,
    "B3c_parse_requoted_json": parse_requoted_json,
    "B3d_parse_loose_lists": parse_loose_lists,
    "B3d_parse_loose_documents": parse_loose_documents,
    "B3e_dedupe_document_lines": dedupe_document_lines,
    "B4_clean_native_lists": clean_native_lists,
    "B5_brand_in_query": brand_in_query,
    "C1_exact_span": exact_span,
    "C2_fuzzy_span": fuzzy_span,
    "C3_span_encoding": span_encoding,
    "C4_priority_fold": priority_fold,
    "C5_augment_brand": augment_brand,
    "C6_label_query_log": label_query_log,
    "C6_label_documents": label_documents,
    "C6_sql_labels": sql_labels,
    "C7_error_capture": error_capture,
    "C8_label_job": label_job,
    "D1_decode_entities": decode_entities,
    "D2_slot_projection": slot_projection,
    "D2_sql_slots": sql_slots,
    "E1_top1_accuracy": top1_accuracy,
    "E2_single_slot_scores": single_slot_scores,
    "E3_list_slot_scores": list_slot_scores,
    "E4_row_alignment": row_alignment,
    "E4_aligned_files": aligned_files,
    "E4_evaluated_failures": evaluated_failures,
    "E5_metric_pack": metric_pack,
    "E5_entity_scores": entity_scores,
    "E6_report_labels": report_labels,
    "E6_report_tags": report_tags,
    "E7_drop_ignored": drop_ignored,
    "E8_decode_ids": decode_ids,
    "F1_split_rows": split_rows,
    "F2_vocabulary": vocabulary,
    "F3_align_labels": align_labels,
    "F3_subword_inputs": subword_inputs,
    "F4_train_and_report": train_and_report,
    "F4_chain_report": chain_report,
    "F5_A12_tag_unseen": tag_unseen,
    "F5_chain_unseen": chain_unseen,
    "G1_counters": counters,
    "G1_stream_totals": stream_totals,
}
