"""Fill-in-the-middle against a plain version, and the rank index against the borders it was fitted to."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotweave.llm import fill_in_middle as M
from slotweave.llm.queries import QUERIES

from .conftest import FOLDER


def plain_version(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op11(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op11_fill_in_middle"](spark, FOLDER).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for r in rows:
        *want, output = plain_version(r.doc_id, r.text)
        assert tuple(got[r.doc_id]) == (r.doc_id, *want, sha(output), sha(r.text or ""))


def test_odd_texts(spark, odd_documents):
    rng = random.Random(3)
    more = [(k, "".join(rng.choice("ab<>PSM é漢😀\n.") for _ in range(rng.randint(0, 60)))) for k in range(1000, 1400)]
    more += [(2000 + k, t) for k, t in enumerate(("<", "<P", "P>", "<S>x", "a<M>", "S><P", "😀", "\n"))]
    docs = odd_documents.select("doc_id", "text", "score").unionByName(
        spark.createDataFrame(more, "doc_id long, text string").withColumn("score", F.lit("")))
    docs = docs.withColumns({"form": F.lit(2), "output": F.lit("x"), "n": F.lit(None)})
    made = M.transform(docs).withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    source = docs.collect()
    want = [(r.doc_id, *plain_version(r.doc_id, r.text), r.text or "") for r in source]
    assert sorted((tuple(r) for r in made), key=str) == sorted(want, key=str)
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert M.transform(docs.where("false")).collect() == []


@pytest.mark.parametrize("block, error", [(1024, 127), (8, 3), (5, 0)])
def test_index_is_exact_and_bounded(block, error):
    rng = np.random.default_rng(5)
    for steps in (rng.integers(1, 9, 5000), np.ones(3000, int), rng.choice([1, 2, 5000], 4000), np.array([7]), np.zeros(0, int)):
        places = np.concatenate([[0], np.cumsum(steps)])
        index = M.RankIndex.fit(places, block, error)
        assert np.array_equal(index.places(np.arange(len(places))), places)
        assert np.abs(index.residual.astype(int)).max() <= error
        assert np.array_equal(np.append(index.first[1:], len(places)) - index.first, index.steps + 1)


def test_even_borders_need_one_line_a_block():
    assert len(M.RankIndex.fit(np.arange(0, 40_960, 4)).first) == 10
