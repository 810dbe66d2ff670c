"""Every operator and stage on odd rows and on empty tables: no crash, a row for each document, defined results."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from slotweave.llm import (
    byte_bpe, fingerprints, license_scan, near_duplicates, packing, pii, quality_model, quotations, toxicity_model,
    weak_supervision,
)
from slotweave.llm.shared import written

BPE, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json"))
DOCUMENT_OPERATORS = {
    "license": lambda d, _: license_scan.summary(license_scan.scan(d)),
    "fingerprints": lambda d, _: fingerprints.edited_by_next(d),
    "quality rules": lambda d, _: weak_supervision.judge(written(weak_supervision.rule_table(d), "rules")),
    "pii": lambda d, _: pii.detect(d),
    "toxicity": lambda d, labels: toxicity_model.score(d, toxicity_model.fit(d, labels)),
    "near duplicates": lambda d, _: near_duplicates.classes(d),
    "quality": lambda d, labels: quality_model.score(d, quality_model.fit(d, labels, metadata=("n_chars", "lang"))),
    "bpe": lambda d, _: byte_bpe.round_trip(d, BPE),
    "bpe ids": lambda d, _: byte_bpe.encode(d, BPE),
}


@pytest.mark.parametrize("name", DOCUMENT_OPERATORS)
def test_one_row_per_document(name, odd_documents, odd_labels):
    rows = DOCUMENT_OPERATORS[name](odd_documents, odd_labels).collect()
    want = [r.doc_id for r in odd_documents.select("doc_id").collect()]
    assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(map(str, want))


@pytest.mark.parametrize("name", DOCUMENT_OPERATORS)
def test_empty_tables(name, odd_documents, odd_labels):
    assert DOCUMENT_OPERATORS[name](odd_documents.where("false"), odd_labels.where("false")).collect() == []


def test_models_without_labels_score_alike(odd_documents, odd_labels):
    none = odd_labels.where("false")
    quality = quality_model.score(odd_documents, quality_model.fit(odd_documents, none)).collect()
    toxic = toxicity_model.score(odd_documents, toxicity_model.fit(odd_documents, none)).collect()
    assert all(abs(r.score - 0.5) < 0.1 for r in quality) and {round(r.score, 6) for r in toxic} == {0.5}


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=lambda s: s[0])
def test_stages_keep_columns(spark, tmp_path, odd_documents, odd_labels, stage):
    odd_labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_documents, odd_documents.where("false")):
        out = stage[1](spark, docs, str(tmp_path))
        rows = out.collect()
        if stage[0] != "packing":
            assert out.columns == docs.columns and len(rows) <= docs.count()


def test_toxicity_stage_keeps_texts_without_evidence(spark, tmp_path, odd_documents):
    schema = "doc_id long, quality int, toxic int"
    for name, rows in (("none", []), ("clean", [(k, 1, 0) for k in range(1, 9)]), ("toxic", [(k, 0, 1) for k in (3, 4, 5)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        kept = corpus_pipeline.STAGES[1][1](spark, odd_documents, f"{tmp_path}/{name}")
        assert kept.count() == odd_documents.count()


def test_a_sampled_id_counts_once(spark):
    docs = [(k, f"good day number {k} of many") for k in range(60)] + [(k, f"vile words vile {k}") for k in range(100, 130)]
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in docs], "doc_id long, toxic int")
    once = spark.createDataFrame(docs, "doc_id long, text string")
    many = once.union(once.where("doc_id in (101, 5)")).union(once.where("doc_id = 101"))
    a, b = (toxicity_model.fit(d, labels) for d in (once, many))
    assert (a.keys == b.keys).all() and (a.weight == b.weight).all() and a.bias == b.bias and len(a.keys)


def test_equal_and_null_documents_are_one(odd_documents):
    kept = near_duplicates.keep_one(odd_documents).select("doc_id", "text").collect()
    ids = sorted(str(r.doc_id) for r in kept)
    # 5 came twice; 6 and 7 have the same words; 1, 2 and the null text without an id have the same bytes: none.
    assert ids == sorted(map(str, [1, 3, 4, 5, None, 6, 8, 9, 10, 11]))


def test_packing_odd_rows(odd_documents):
    rows = packing.pack(odd_documents, WORDS).collect()
    assert len({r.sequence_id for r in rows}) > 10 and all(r.length >= 1 and r.offset + r.length <= 2048 for r in rows)
    assert sum(r.length for r in rows if r.doc_id == 2) == 1
    assert packing.pack(odd_documents.where("false"), WORDS).collect() == []


def test_redaction_leaves_other_columns(odd_documents):
    out = pii.redact_documents(odd_documents.withColumn("text", F.concat("text", F.lit(" a@b.cd"))))
    assert out.where("text is null").count() == 2 and out.where("text not like '%[EMAIL]'").count() == 0
    assert out.where("n_chars <> char_length(text)").count() == 0


def test_conversations_with_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, reply_to string, thread string, quoted string"
    rows = [(1, 0, "u", "Hello there friend.\nHow are you?"), (1, 1, "a", "On Monday X wrote:\n> Hello there friend.\n> How are you?\nFine."),
            (1, 2, "u", "> > hello THERE friend\n> Fine.\nGreat."), (1, 3, "a", "> not there\nx"), (1, 3, "a", "> not there\nx"),
            (None, 1, None, "> Great."), (2, None, None, None), (2, 0, "u", "> Great."), (3, 0, "u", "y" * 100_000), (3, 1, "u", "")]
    table = spark.createDataFrame([(*r, None, None, None) for r in rows], schema)
    got = {(r.conv_id, r.turn): r for r in quotations.conversations(table).collect()}
    assert quotations.conversations(table).count() == len(rows)
    assert [(got[1, k].reply_to, got[1, k].thread, got[1, k].depth, got[1, k].own_text) for k in range(4)] == [
        (None, 0, 0, "Hello there friend.\nHow are you?"), (0, 0, 1, "Fine."), (1, 0, 2, "Great."), (None, 3, 0, "x")]
    assert got[None, 1].reply_to is None and got[2, 0].n_quotes == 1 and got[2, 0].n_linked == 0
    assert quotations.conversations(table.where("false")).collect() == []


def test_quotes_of_parts_against_known_originals(spark):
    """Generated conversations: whole, partial, re-wrapped, nested and repeated quotes, and chains of replies."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    wrap = lambda text, n: [" ".join(w[k:k + n]) for w in [text.split()] for k in range(0, len(w), n)]
    rows, want = [], {}
    for conv in range(40):
        own = []
        for turn in range(12):
            text = " ".join(sentence(rng.randint(4, 14)) for _ in range(rng.randint(3, 6)))
            lines, target = [], None
            if turn and rng.random() < 0.8:
                target = rng.randrange(turn)
                source = own[target]
                cut = source.split(". ")
                at = rng.randrange(len(cut))
                words = source.split()
                start = rng.randrange(max(len(words) - 10, 1))
                lines = {
                    "whole": [source], "sentence": [cut[at]], "wrapped": wrap(source, rng.randint(4, 9)),
                    "middle": wrap(" ".join(words[start:start + 10]), 7), "tail": wrap(" ".join(words[-12:]), 5),
                }[rng.choice(["whole", "sentence", "wrapped", "middle", "tail"])]
                older = [f"> > {line}" for line in wrap(own[rng.randrange(target)], 8)] if target and rng.random() < 0.4 else []
                lines = [*older, *(f"> {line}" for line in lines)] * rng.choice([1, 1, 2])
            rows.append((conv, turn, "u", "\n".join([*lines, text])))
            own.append(text)
            want[conv, turn] = target
    for k in range(60):  # a long chain of replies
        rows.append((99, k, "u", f"> {rows[-1][3].splitlines()[-1]}\n{sentence(9)}" if k else sentence(9)))
        want[99, k] = k - 1 if k else None
    got = quotations.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.turn): r.reply_to for r in got} == want
    depth, thread = {}, {}
    for key in sorted(want):
        up = (key[0], want[key])
        depth[key], thread[key] = (depth[up] + 1, thread[up]) if want[key] is not None else (0, key[1])
    assert {(r.conv_id, r.turn): (r.depth, r.thread) for r in got} == {k: (depth[k], thread[k]) for k in want}


def test_a_common_run_of_nine_words_has_a_chosen_window():
    rng = random.Random(1)
    for _ in range(300):
        shared = [f"s{rng.randrange(50)}" for _ in range(quotations.WINDOW + quotations.CHOSEN - 1)]
        a, b = ([f"{side}{k}" for k in range(rng.randint(0, 9))] for side in "ab")
        one, two = (set(quotations.part_keys(" ".join([*x, *shared, *x]))) for x in (a, b))
        assert one & two
    assert quotations.part_keys("") == [] and len(quotations.part_keys("one two three")) == 1


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext, conf = Context, {}

    from slotweave.llm.shared import shared_path
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(Session, "x")
    Session.conf = {"spark.checkpoint.dir": "/shared/"}
    assert shared_path(Session, "x").startswith("/shared/x-")
