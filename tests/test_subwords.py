"""Sub-words against a plain longest match, a word-piece file, and the word ids of another library."""

import hashlib
import json
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

from slotweave.functions import subwords as S
from slotweave.operators.training_data import closed_vocabulary, encode_tags, model_inputs
from slotweave.plans.queries import QUERIES, _labelled_documents

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "un", "##aff", "##able", "##a", "red", "##d", "shoe", "##s", "-", "cafe", "##f", "1", "##2"]


@pytest.fixture(scope="module")
def word_pieces(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("vocabulary") / "vocab.txt"
    path.write_text("\n".join(PIECES) + "\n")
    return S.read_vocabulary(spark, str(path))


def byte_letters(vocabulary):
    """Letters of a byte-level vocabulary by its first 256 pieces: the visible bytes come first."""
    letters = [p for p, _ in sorted(vocabulary.items(), key=lambda x: x[1])[:256]]
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return dict(zip([*visible, *(b for b in range(256) if b not in visible)], letters))


def plain_pieces(token, vocabulary, letter):
    """Longest match by trying all lengths."""
    out = []
    for part in re.findall(r"[^\W_]+|\S", token.lower()):
        word, at = [letter[b] for b in part.encode()], 0
        while at < len(word):
            for end in range(min(len(word), at + 80), at, -1):
                piece = "".join(word[at:end]) + ("</w>" if end == len(word) else "")
                if piece in vocabulary:
                    out.append(vocabulary[piece])
                    at = end
                    break
            else:
                raise AssertionError(part)
    return out


def test_documents_against_a_plain_match(spark):
    vocabulary = json.load(open(PATH))["model"]["vocab"]
    documents = encode_tags(_labelled_documents(spark, FOLDER), closed_vocabulary(spark)).select("doc_id", "tokens", "tag_ids").collect()
    got = {r.doc_id: r for r in QUERIES["F3_subword_inputs"](spark, FOLDER).collect()}
    met, letter = {}, byte_letters(vocabulary)
    assert len(got) == len(documents)
    for row in documents:
        ids, words = [], []
        for k, token in enumerate(row.tokens):
            if token not in met:
                met[token] = plain_pieces(token, vocabulary, letter)
            ids += met[token]
            words += [k] * len(met[token])
        n, ids, words = len(ids), ids[:126], words[:126]
        labels = [row.tag_ids[w] if j == 0 or words[j - 1] != w else -100 for j, w in enumerate(words)]
        rest = 126 - len(ids)
        r = got[row.doc_id]
        assert r.input_ids == " ".join(map(str, [49406, *ids, 49407, *[0] * rest]))
        assert r.labels == " ".join(map(str, [-100, *labels, -100, *[-100] * rest]))
        assert (r.n_used, r.n_pieces) == (len(ids) + 2, n)
        assert r.words_digest == hashlib.md5(" ".join(map(str, [-1, *words, -1, *[-1] * rest])).encode()).hexdigest()


def test_word_pieces_against_another_library(spark, word_pieces):
    other = Tokenizer(models.WordPiece({p: k for k, p in enumerate(PIECES)}, unk_token="[UNK]"))
    other.normalizer = normalizers.BertNormalizer(strip_accents=True, lowercase=True)
    other.pre_tokenizer = pre_tokenizers.BertPreTokenizer()
    rng = random.Random(0)
    rows = [["unaffable", "Red", "shoes", "redd", "xyz", "café", "un-red", "12", "", "caff"], [], ["shoe"]]
    rows += [["".join(rng.choice(["un", "aff", "able", "red", "d", "-", "1", "2", "x", "É", "s"]) for _ in range(rng.randint(1, 5)))
              for _ in range(rng.randint(0, 6))] for _ in range(200)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "k int, tokens array<string>")
    got = df.select("k", S.subwords(F.col("tokens"), word_pieces, strip_accents=True).alias("s")).collect()
    for r in got:
        encoded = other.encode(rows[r.k], is_pretokenized=True, add_special_tokens=False)
        assert (r.s.ids, r.s.word_ids) == (encoded.ids, encoded.word_ids)


def test_odd_tokens(spark, word_pieces):
    schema = "tokens array<string>, tag_ids array<int>, labels string, word_ids string"
    rows = [(None, None, "", ""), ([], [], "", ""), ([None, " ", "red"], [1, 2, 3], "", ""), (["red" * 50_000], [4], "", ""), (["\0red\0"], [5], "", ""), (["red"], [5], "", "")]
    out = model_inputs(spark.createDataFrame(rows, schema), word_pieces, max_length=5).collect()
    assert [r.input_ids for r in out] == [[2, 3, 0, 0, 0], [2, 3, 0, 0, 0], [2, 8, 3, 0, 0], [2, 1, 3, 0, 0], [2, 8, 3, 0, 0], [2, 8, 3, 0, 0]]
    assert [r.labels for r in out] == [[-100] * 5] * 2 + [[-100, x, -100, -100, -100] for x in (3, 4, 5, 5)]
    assert out[2].word_ids == [None, 2, None, None, None] and out[2].attention_mask == [1, 1, 1, 0, 0]
    cut = model_inputs(spark.createDataFrame([(["shoes", "red"], [7, 8])], "tokens array<string>, tag_ids array<int>"), word_pieces, max_length=4).first()
    assert (cut.input_ids, cut.labels, cut.n_pieces) == ([2, 10, 11, 3], [-100, 7, -100, -100], 3)


def test_vocabularies_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"model": {"vocab": {"a": 0}}}))
    (tmp_path / "b.txt").write_text("red\nblue\n")
    for name, message in (("a.json", "marked"), ("b.txt", "unknown words")):
        with pytest.raises(ValueError, match=message):
            S.read_vocabulary(spark, str(tmp_path / name))


def test_words_are_met_again_after_the_bound(word_pieces, monkeypatch):
    monkeypatch.setattr(S, "KEPT_WORDS", 2)
    matcher = S.PieceMatcher(word_pieces)
    words = ["red", "shoes", "unaffable", "red", "redd"] * 3
    assert [matcher.pieces(w) for w in words] == [[8], [10, 11], [4, 5, 6], [8], [8, 9]] * 3
