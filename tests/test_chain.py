"""The chain tagger against enumeration of all paths, numeric gradients, and runs that broke off."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from slotweave.functions.spans import TAGS
from slotweave.operators import chain_model as M
from slotweave.operators import chain_tagger as C
from slotweave.operators.labeling import label_queries
from slotweave.operators.metrics import span_report
from slotweave.operators.tagger import TEMPLATES, Tagger, train_tagger
from slotweave.operators.training_data import train_validation_split
from slotweave.plans import evaluate_job, label_job, train_job
from slotweave.plans.queries import QUERIES
from slotweave.plans.query_log import query_log

FOLDER = "/root/testdata/sf0.001"
TAG_LIST = sorted(TAGS)
RULES = M.bioes_rules(TAG_LIST)
SIZE = len(TAG_LIST)


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "labelled.parquet")
    label_job.label_table(query_log(spark, spark.read.parquet(f"{FOLDER}/part.parquet")), path)
    return spark.read.parquet(path)


def allowed(tags):
    """The BIOES rules, by walking through a sequence."""
    open_ = None
    for tag in tags:
        prefix, kind = tag[0], tag[2:]
        if (prefix in "IE") != (open_ is not None) or prefix in "IE" and kind != open_:
            return False
        open_ = kind if prefix in "BI" else None
    return open_ is None


def spans(tags):
    found, k = set(), 0
    while k < len(tags):
        end = k
        if tags[k][0] == "B":
            end += 1
            while end < len(tags) and tags[end] == "I-" + tags[k][2:]:
                end += 1
            if end < len(tags) and tags[end] == "E-" + tags[k][2:]:
                found.add((k, end, tags[k][2:]))
        elif tags[k][0] == "S":
            found.add((k, k, tags[k][2:]))
        k += 1
    return found


def random_chain(seed):
    rng = np.random.default_rng(seed)
    lengths = [0, 1, 3, 2, 4, 0, 1, 3, 2]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    chain = M.Chain(rng.normal(size=(SIZE, SIZE)), rng.normal(size=SIZE), rng.normal(size=SIZE))
    return 2 * rng.normal(size=(offsets[-1], SIZE)), offsets, chain


def test_rules():
    for n in (1, 2, 3):
        for path in itertools.product(range(SIZE), repeat=n):
            ids, offsets = np.array(path), np.array([0, n])
            assert M.keeps_rules(ids, offsets, RULES)[0] == allowed([TAG_LIST[k] for k in path])


@pytest.mark.parametrize("seed", [0, 1])
def test_sums_and_best_paths_against_all_paths(seed):
    scores, offsets, chain = random_chain(seed)
    got, best = M.expectation(scores, offsets, chain, RULES), M.best_paths(scores, offsets, chain, RULES)
    total, marginals, steps = 0.0, np.zeros_like(scores), np.zeros((SIZE, SIZE))
    for a, b in zip(offsets[:-1], offsets[1:]):
        if a == b:
            continue
        paths = [p for p in itertools.product(range(SIZE), repeat=b - a) if allowed([TAG_LIST[k] for k in p])]
        weights = [chain.first[p[0]] + chain.last[p[-1]] + sum(scores[a + i, k] for i, k in enumerate(p))
                   + sum(chain.step[x, y] for x, y in zip(p, p[1:])) for p in paths]
        whole = np.logaddexp.reduce(weights)
        total += whole
        for p, w in zip(paths, weights):
            for i, k in enumerate(p):
                marginals[a + i, k] += np.exp(w - whole)
            for x, y in zip(p, p[1:]):
                steps[x, y] += np.exp(w - whole)
        assert tuple(best[a:b]) == max(zip(weights, paths))[1]
    assert got.log_total == pytest.approx(total, abs=1e-9)
    assert np.allclose(got.tags, marginals, atol=1e-12) and np.allclose(got.chain.step, steps, atol=1e-12)


def test_extreme_weights_stay_numbers():
    scores, offsets, chain = random_chain(3)
    got = M.expectation(scores * 1e4, offsets, M.Chain(*(w * 1e4 for w in chain)), RULES)
    assert np.isfinite(got.log_total) and np.isfinite(got.tags).all() and np.allclose(got.tags.sum(axis=1), 1)
    ids = M.best_paths(scores * 1e4, offsets, chain, RULES)
    assert M.keeps_rules(ids, offsets, RULES).all()


def test_long_sequences_beside_short_ones():
    rng = np.random.default_rng(0)
    lengths = [40_000, 1, 7]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    scores, (_, _, chain) = rng.normal(size=(offsets[-1], SIZE)), random_chain(0)
    ids, sums = M.best_paths(scores, offsets, chain, RULES), M.expectation(scores, offsets, chain, RULES)
    assert M.keeps_rules(ids, offsets, RULES).all() and np.allclose(sums.tags.sum(axis=1), 1)
    for a, b in zip(offsets[1:-1], offsets[2:]):
        alone = np.array([0, b - a])
        assert np.array_equal(M.best_paths(scores[a:b], alone, chain, RULES), ids[a:b])
        assert np.allclose(M.expectation(scores[a:b], alone, chain, RULES).tags, sums.tags[a:b])


def test_span_counts(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(300):
        n = rng.randint(0, 8)
        true = [rng.choice(TAG_LIST[:6]) for _ in range(n)]
        rows.append((true, [t if rng.random() < 0.8 else rng.choice(TAG_LIST[:6]) for t in true]))
    flat = [np.array([TAG_LIST.index(t) for r in rows for t in r[side]]) for side in (0, 1)]
    offsets = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])])
    a, b = ([spans(r[side]) for r in rows] for side in (0, 1))
    want = sum(len(x & y) for x, y in zip(a, b)), sum(map(len, b)), sum(map(len, a))
    assert M.span_counts(*flat, offsets, TAG_LIST) == want
    report = span_report(spark.createDataFrame(rows, "t array<string>, p array<string>"), "t", "p").first()
    assert report.support == want[2] and report.precision == pytest.approx(want[0] / want[1]) and report.recall == pytest.approx(want[0] / want[2])


def test_gradient(spark, labelled):
    examples = C.chain_examples(labelled.limit(20), TAG_LIST, 8).cache()
    objective = C.Objective(examples, TAG_LIST, 8, 0.01)
    rng = np.random.default_rng(0)
    table = rng.normal(size=(objective.rows, SIZE)) * 0.3
    value, gradient = objective(table)
    direction = rng.normal(size=table.shape)
    ahead, behind = (objective(table + h * direction)[0] for h in (1e-4, -1e-4))
    assert (ahead - behind) / 2e-4 == pytest.approx((gradient * direction).sum(), rel=1e-5)


def test_rows_that_teach_nothing(spark, tmp_path):
    schema = "tokens array<string>, bioes_tags array<string>"
    rows = [(["red", "nike"], ["O", "S-Brand"])] * 5 + [(["a"], ["I-Brand"]), (["a", "b"], ["O"]), ([], []), (None, None), (None, ["O"])]
    objective = C.Objective(C.chain_examples(spark.createDataFrame(rows, schema), TAG_LIST, 16), TAG_LIST, 16, 1e-3)
    assert (objective.queries, objective.tokens, objective.malformed) == (5, 10, 1)
    tagger = C.train_chain(spark.createDataFrame(rows, schema), str(tmp_path / "run"), buckets=16, passes=5)
    out = tagger.tag_tokens(spark.createDataFrame([(["red", "nike"], None), ([], None), (None, None)], "tokens array<string>, n int"))
    assert [r.bioes_tags for r in out.collect()] == [["O", "S-Brand"], [], None]
    with pytest.raises(ValueError, match="no labelled token"):
        C.train_chain(spark.createDataFrame(rows[5:], schema), str(tmp_path / "none"), buckets=16)
    with pytest.raises(Exception, match="unknown tag S-Colour"):
        C.chain_examples(spark.createDataFrame([(["x"], ["S-Colour"])], schema), TAG_LIST).collect()


class Lost(Exception):
    pass


def test_a_run_that_broke_off_goes_on(labelled, tmp_path, monkeypatch):
    training, validation = train_validation_split(labelled)
    whole = C.train_chain(training, str(tmp_path / "whole"), validation, buckets=64, passes=9)
    write = C.PassStore.write

    def lost(store, state):
        if state.number == 4:
            raise Lost
        write(store, state)

    monkeypatch.setattr(C.PassStore, "write", lost)
    with pytest.raises(Lost):
        C.train_chain(training, str(tmp_path / "broken"), validation, buckets=64, passes=9)
    monkeypatch.undo()
    left = tmp_path / "broken" / "passes" / "pass=4" / "_temporary"
    left.mkdir(parents=True)
    (left / "part-0.parquet").write_bytes(b"half a file")
    resumed = C.train_chain(training, str(tmp_path / "broken"), validation, buckets=64, passes=9)
    assert resumed.history == whole.history and np.array_equal(resumed.weights.table, whole.weights.table)
    best = max(whole.history, key=lambda h: (h[2], h[0]))
    examples = C.chain_examples(validation, TAG_LIST, 64)
    assert C.span_f1(examples, whole.weights.table, TAG_LIST) == best[2]
    with pytest.raises(ValueError, match="another training run"):
        C.train_chain(training, str(tmp_path / "whole"), validation, buckets=64, reg_param=0.5)


def test_chain_beats_single_decisions(labelled, tmp_path):
    training, validation = train_validation_split(labelled)
    rest, chosen = train_validation_split(training, percent=10, seed=1)
    chain = C.train_chain(rest, str(tmp_path / "run"), chosen, passes=10)
    chain.save(str(tmp_path / "model"))
    loaded = C.load_tagger(str(tmp_path / "model"))
    assert np.array_equal(loaded.weights.table, chain.weights.table) and loaded.history == chain.history
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        chain.save(str(tmp_path / "model"))
    scores = {}
    for name, tagger in (("alone", train_tagger(training, max_iter=15)), ("chain", loaded)):
        tagged = tagger.tag_tokens(validation.select("tokens", "bioes_tags"), output="predicted")
        scores[name] = span_report(tagged, "bioes_tags", "predicted").first().f1
        if name == "chain":
            assert all(allowed(r.predicted) for r in tagged.collect())
    assert scores["chain"] > scores["alone"]


def test_tags_of_unseen_queries_against_a_plain_decoder(spark):
    """The registered query's slots follow from its tags, by a plain walk."""
    rows = QUERIES["F5_chain_unseen"](spark, FOLDER).collect()
    assert rows
    for r in rows:
        tokens, tags = r.tokens.split(" "), r.bioes_tags.split(" ")
        assert len(tokens) == len(tags) and allowed(tags)
        texts = {}
        for a, b, kind in sorted(spans(tags)):
            texts.setdefault(kind, []).append(" ".join(tokens[a:b + 1]))
        assert r.brand_pred == texts.get("Brand", [""])[0] and r.product_type_pred == texts.get("ProductType", [""])[0]
        assert r.attributes_pred == "|".join(texts.get("Attribute", []))


def test_paths_of_batches_against_scores_summed_by_hand(spark, labelled):
    rng = np.random.default_rng(2)
    weights = C.Weights(rng.normal(size=(TEMPLATES * 32 + SIZE + 2, SIZE)))
    tagger = C.ChainTagger(weights.table, TAG_LIST, 32)
    short = labelled.where("size(tokens) <= 4").select("tokens").limit(12)
    features = C.with_features(short, buckets=32).collect()
    for row, tagged in zip(features, tagger.tag_tokens(short).collect(), strict=True):
        cells = [sum(weights.table[f] for f in row._features[i:i + TEMPLATES]) for i in range(0, len(row._features), TEMPLATES)]
        paths = [p for p in itertools.product(range(SIZE), repeat=len(cells)) if allowed([TAG_LIST[k] for k in p])]
        chain = weights.chain
        score = lambda p: (chain.first[p[0]] + chain.last[p[-1]] + sum(c[k] for c, k in zip(cells, p))
                           + sum(chain.step[x, y] for x, y in zip(p, p[1:])))
        assert tagged.bioes_tags == [TAG_LIST[k] for k in max(paths, key=score)]


def test_train_job_with_a_chain(spark, labelled, tmp_path):
    source, model = str(tmp_path / "in.parquet"), str(tmp_path / "model")
    labelled.write.parquet(source)
    train_job.run(spark, source, model, max_iter=3, buckets=64, kind="chain", passes=str(tmp_path / "passes"))
    assert spark.read.parquet(f"{model}/report/objective").where("span_f1 is not null").count() == 4
    before = C.load_tagger(model)
    with pytest.raises(FileExistsError):
        train_job.run(spark, source, model, max_iter=1, buckets=64, kind="chain")
    with pytest.raises(FileExistsError):
        train_job.run(spark, source, model, max_iter=1, buckets=64)
    assert np.array_equal(C.load_tagger(model).weights.table, before.weights.table)
    train_job.main(["--input", source, "--model-dir", model, "--kind", "chain", "--max-iter", "1", "--buckets", "64", "--mode", "overwrite"])
    assert len(C.load_tagger(model).history) == 2
    test = spark.createDataFrame([("red shoe", "", "['red']", "shoe")], "query string, brand string, attributes string, product_type string")
    test.write.parquet(str(tmp_path / "test.parquet"))
    assert evaluate_job.run(spark, str(tmp_path / "test.parquet"), str(tmp_path / "out"), model).count() == 1


def test_independent_model_is_not_overwritten(spark, labelled, tmp_path):
    tagger = train_tagger(label_queries(query_log(spark, spark.read.parquet(f"{FOLDER}/part.parquet"))), buckets=64, max_iter=1)
    tagger.save(str(tmp_path / "model"))
    with pytest.raises(Exception, match="already exists"):
        tagger.save(str(tmp_path / "model"))
    tagger.save(str(tmp_path / "model"), "overwrite")
    assert type(C.load_tagger(str(tmp_path / "model"))) is Tagger


def test_sparse_tables_round_trip():
    table = np.zeros((6, 3))
    table[4] = [0.0, 1.5, -2.0]
    assert np.array_equal(C._dense(C._sparse("weights", table), "weights", (6, 3)), table)
    assert np.array_equal(C._dense(pa.concat_tables([C._sparse("a", table)]), "b", (6, 3)), np.zeros((6, 3)))
