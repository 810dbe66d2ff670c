import random

import plain_model
from pyspark.sql import functions as F

from slotweave.functions import (
    TAGS, apply_bioes_tags, clean_text, extract_entities, is_brand_in_query, parse_attributes, tokenize_query,
)
from slotweave.functions.attributes import number_text
from slotweave.functions.spans import fuzzy_offset
from slotweave.operators.labeling import label_queries
from slotweave.operators.training_data import align_labels

CLEAN = [
    ("  Nike\t AIR  max ", "Nike AIR max", "Nike AIR max"),
    ("a,b.c", "a, b. c", "a , b . c"),
    ("3.5 oz", "3. 5 oz", "3 . 5 oz"),
    ('say "hi" `x´ “q”', "say 'hi' 'x' “q”", "say 'hi' 'x' “q”"),
    ("a\xa0b c\x1cd", "a b c d", "a b c d"),
    ("a　b c\x85d e\x0bf", "a b c d e f", "a b c d e f"),
    ("!!", "! !", "! !"),
    ("wait...what?", "wait. . . what?", "wait . . . what ?"),
    ("a , b", "a , b", "a , b"),
    ("it`s", "it's", "it's"),
    (None, "", ""),
    ("", "", ""),
    (" \n ", "", ""),
]
ATTRIBUTES = [
    ('["red","Red","red"]', ["red", "Red"]),
    ("['red', 'blue']", ["red", "blue"]),
    ("""["men's", 'x']""", ["men", ","]),
    ("['men's','red']", ["men", ","]),
    ('{"a":"x","b":"y"}', ["x", "y"]),
    ('{"a":"x","b":"q","a":"y"}', ["y", "q"]),
    ("{'a': 'x'}", ["x"]),
    ('[1, 1.5, true, null, 0, "0", ""]', ["1", "1. 5", "True", "0"]),
    ('{"a":0,"b":true,"c":"x"}', ["True", "x"]),
    ("red, blue", ["red", "blue"]),
    ("[red, blue]", ["red, blue"]),
    ("(a)(b)", ["a", "b"]),
    ("it's 5\"", ["s 5"]),
    ('["a"] x', ["a"]),
    ('["a"] ["b"]', ["a", "b"]),
    ('[" "]', []),
    ("( )", []),
    ('{"c":["red"]}', ["c", "red"]),
    ('{"c":["red","blue"]}', ["c", "red", "blue"]),
    ('["a", [], {}, [null], NaN]', ["a"]),
    (' [ "a" , "b,c" ] ', ["a", "b, c"]),
    ('["a\\u0041\\n \\"b\\""]', ["aA 'b'"]),
    ('["[x]", "{y}"]', ["[x]", "{y}"]),
    ("['a\nb']", ["a b"]),
    *((text, []) for text in ('"red"', "'red'", "12", " 12 ", "null", "nan", "NaN", "true", "", "[]", "{}", "()", "[ ]", None)),
]
ROWS = [
    ("red nike shoes", "Nike", '["red"]', "shoes", "red nike shoes", "S-Attribute S-Brand S-ProductType", False),
    ("running shoes", "New Balance", "['blue']", "running shoes", "running shoes New Balance",
     "B-ProductType E-ProductType B-Brand E-Brand", True),
    ("red red shoe", None, '["red","red"]', "shoe", "red red shoe", "S-Attribute O S-ProductType", False),
    ("brand#25 ring", "Brand#2", None, "ring", "brand#25 ring", "O S-ProductType", False),
    ("red shoe", "", '["red shoe"]', "shoe", "red shoe", "B-Attribute E-Attribute", False),
    ("", "Nike", '["x"]', "shoe", "", "", False),
    ("cotton crew neck long sleeve tee", None, '["cotton crew neck short sleeve"]', "tee",
     "cotton crew neck long sleeve tee",
     "B-Attribute I-Attribute I-Attribute I-Attribute E-Attribute S-ProductType", False),
    ("a b c x", "", '["a b c d"]', "", "a b c x", "O O O O", False),
    ("L.L. Bean boots", "L.L. Bean", None, "boots", "L . L . Bean boots",
     "B-Brand I-Brand I-Brand I-Brand E-Brand S-ProductType", False),
    ("nike air max", "NIKE", '["air"]', "air max", "nike air max", "S-Brand S-Attribute O", False),
    ("x", "A B C", None, None, "x A B C", "O B-Brand I-Brand E-Brand", True),
]
DECODE = [
    ("a b c", "B-Brand I-Brand E-Brand", ["a b c"], [], []),
    ("a b c", "B-Brand S-Attribute E-Brand", ["a c"], ["b"], []),
    ("a b", "B-Brand E-Attribute", ["a b"], [], []),
    ("a b", "I-Brand E-Brand", [], [], []),
    ("a b c", "B-Brand O E-Brand", [], [], []),
    ("a b c d", "B-Brand B-Attribute E-Attribute B-ProductType", [], ["b c"], []),
    ("a b", "S-Brand", ["a"], [], []),
    ("S-x B-y", "S-Brand S-Brand", ["S-x", "B-y"], [], []),
    ("a b", "S-Unknown S-Brand", ["b"], [], []),
]


def test_clean_and_tokenize(spark):
    df = spark.createDataFrame([(text,) for text, _, _ in CLEAN], "text string")
    rows = df.select(clean_text(F.col("text")), F.array_join(tokenize_query(F.col("text")), " ")).collect()
    assert [tuple(row) for row in rows] == [(cleaned, line) for _, cleaned, line in CLEAN]


def test_brand_in_query(spark):
    rows = [("Nike", "red NIKE shoe", True), ("Brand#2", "brand#25", True), (None, "x", False), ("", "x", False), ("a", None, False)]
    df = spark.createDataFrame([row[:2] for row in rows], "brand string, query string")
    assert [r[0] for r in df.select(is_brand_in_query(F.col("brand"), F.col("query"))).collect()] == [r[2] for r in rows]


def test_parse_attributes(spark):
    df = spark.createDataFrame([(text,) for text, _ in ATTRIBUTES], "text string")
    rows = df.select(parse_attributes(F.col("text"))).collect()
    assert [(text, row[0]) for (text, _), row in zip(ATTRIBUTES, rows)] == ATTRIBUTES


def test_long_attribute_texts_do_not_overflow(spark):
    items = [f"item {k}" for k in range(20000)]
    text = "[" + ", ".join(f'"{item}"' for item in items) + ', "' + "\\n" * 20000 + '"]'
    df = spark.createDataFrame([(text,), (text[:-1],)], "text string")
    strict, broken = (row[0] for row in df.select(parse_attributes(F.col("text"))).collect())
    assert strict == items
    assert broken == [*items, "\\n" * 20000]


def test_number_text(spark):
    numbers = [1.0, 1.5, 1e7, 12345678.0, 1e15, 1e16, 1.5e20, 1e-3, 1e-4, 1.5e-5, -2.5e-7, 123456789.125, float("inf"), -1e300]
    df = spark.createDataFrame([(number,) for number in numbers], "x double")
    assert [row[0] for row in df.select(number_text(F.col("x"))).collect()] == [str(number) for number in numbers]


def test_label_rows(spark):
    df = spark.createDataFrame([row[:4] for row in ROWS], "query string, brand string, attributes string, product_type string")
    rows = label_queries(df).collect()
    got = [(" ".join(r.tokens), " ".join(r.bioes_tags), r.brand_added) for r in rows]
    assert got == [row[4:] for row in ROWS]
    assert all(r.error is None for r in rows)


def test_label_native_and_variant_lists(spark):
    df = spark.createDataFrame([("red red shoe", ["red", "red", "", None])], "query string, attributes array<string>")
    row = label_queries(df.withColumn("product_type", F.lit("shoe"))).first()
    assert (row.attributes, row.bioes_tags) == (["red", "red"], ["S-Attribute", "S-Attribute", "S-ProductType"])
    values = ['["red", "red", 0, null]', '"[\'red\', \'red\']"', "12", '{"a": "red"}']
    mixed = spark.createDataFrame([(value,) for value in values], "j string").select(
        F.lit("red red").alias("query"), F.try_parse_json("j").alias("attributes")
    )
    assert [r.attributes for r in label_queries(mixed).collect()] == [["red", "red"], ["red"], [], []]
    numbers = spark.createDataFrame([("x", [1, 0, 2])], "query string, attributes array<int>")
    assert label_queries(numbers).first().attributes == ["1", "2"]


def test_decode_rows(spark):
    df = spark.createDataFrame([row[:2] for row in DECODE], "tokens string, tags string")
    rows = df.select(extract_entities(F.split("tokens", " "), F.split("tags", " ")).alias("e")).select("e.*").collect()
    assert [tuple(row) for row in rows] == [row[2:] for row in DECODE]


def test_spans_against_the_plain_model(spark):
    rng, cases = random.Random(3), []
    for _ in range(600):
        tokens = [rng.choice("abcAB") for _ in range(rng.randint(1, 14))]
        entities = []
        for label in ("Brand", "Attribute", "ProductType"):
            start, size = rng.randrange(len(tokens)), rng.choice([1, 1, 2, 3, 5, 6, 10])
            entity = tokens[start:start + size]
            entity = [rng.choice("abc") if rng.random() < 0.12 else token for token in entity]
            entities.append((" ".join(entity), label))
        cases.append((tokens, *(text for text, _ in entities)))
    df = spark.createDataFrame(cases, "tokens array<string>, Brand string, Attribute string, ProductType string")
    df = df.withColumn("tags", F.transform("tokens", lambda _: F.lit("O")))
    for label in ("Brand", "Attribute", "ProductType"):
        df = df.withColumn("tags", apply_bioes_tags(F.col("tokens"), F.col("tags"), F.col(label), label))
    fuzzy = 0
    for row in df.collect():
        entities = [(row[label].split(), label) for label in ("Brand", "Attribute", "ProductType")]
        assert row.tags == plain_model.tag(row.tokens, entities)
        assert set(row.tags) <= set(TAGS)
        line = " ".join(row.tokens).lower()
        fuzzy += any(f"B-{label}" in row.tags and " ".join(words).lower() not in line for words, label in entities)
    assert fuzzy > 5


def test_decoding_against_the_plain_model(spark):
    rng = random.Random(5)
    cases = []
    for _ in range(800):
        size = rng.randint(0, 12)
        cases.append(([rng.choice("xyz") + str(k) for k in range(size)], [rng.choice(TAGS) for _ in range(size + rng.choice([0, 0, 1]))]))
    df = spark.createDataFrame(cases, "tokens array<string>, tags array<string>")
    for row in df.select("*", extract_entities(F.col("tokens"), F.col("tags")).alias("e")).collect():
        assert row.e.asDict() == plain_model.decode(row.tokens, row.tags)


def test_align_labels(spark):
    df = spark.sql("select array(null, 0, 0, 1, null, null) as w, array(3, 7) as l")
    assert df.select(align_labels(F.col("w"), F.col("l"), 6)).first()[0] == [-100, 3, -100, 7, -100, -100]
    assert df.select(align_labels(F.col("w"), F.col("l"), 2)).first()[0] == [-100, 3]
    assert len(df.select(align_labels(F.col("w"), F.col("l"))).first()[0]) == 128


def test_fuzzy_offset_tries_every_start(spark):
    """Overlapping places, words that look like patterns, tagged cells, entities of one to twelve words."""
    draw, kinds, rows = random.Random(5), ("a", "b", "c", "d\\E", "e.f", "g*", "x"), []
    for number in range(3000):
        cells = [draw.choice((*kinds, "\x1fB-Brand")) for _ in range(draw.randrange(40))]
        begin, size = draw.randrange(len(cells) + 1), draw.randrange(13)
        words = [word if draw.random() < 0.85 else draw.choice(kinds) for word in cells[begin:begin + size]] or [draw.choice(kinds) for _ in range(size)]
        rows.append((number, cells, [word.lstrip("\x1f") for word in words]))

    def plain(cells, words):
        for start in range(len(cells) - len(words) + 1):
            run = cells[start:start + len(words)]
            if not any(cell.startswith("\x1f") for cell in run) and 5 * sum(map(str.__eq__, run, words)) >= 4 * len(words):
                return start
        return None

    df = spark.createDataFrame(rows, "number int, cells array<string>, words array<string>")
    found = {row.number: row.place for row in df.select("number", fuzzy_offset(F.col("cells"), F.col("words")).alias("place")).collect()}
    assert found == {number: plain(cells, words) for number, cells, words in rows}
    assert sum(place is not None for place in found.values()) > 500
