import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions.jsonkeys import canonical_key_sql, is_json_sql, json_array_key
from docloom.functions.keyspec import split_key_spec
from docloom.operators.keys import assign_chunks, plan_keys

# Key specs and the number of keys they stand for.
SIZES = {
    '["north",7];["south",8]': 2,
    '["left;right",7];["south",8];"x"': 3,
    "[one;two;three];[four;five]": 2,
    '["open[ed;x",7];["south",8]': 2,
    '["day((05-09))",7];["south",8]': 6,
    "room-((3-6))": 4,
    '["((0000-0999))"]': 1000,
    '"p";"q";"r"': 3,
    '["n",((1-3))];["s",((1-4))]': 7,
    '["day((01-02))",((10-14))]': 5,
    "late((9-2))": 0,
    "step((98-101))": 4,
    "first;;third;": 3,
}


def keys_of(spark, spec):
    return [r["raw_key"] for r in plan_keys(spark, spec).orderBy("pos", "sub_pos").collect()]


@pytest.mark.parametrize("spec", SIZES, ids=range(len(SIZES)))
def test_key_counts(spark, spec):
    assert len(keys_of(spark, spec)) == SIZES[spec]


def test_key_texts(spark):
    assert keys_of(spark, "room-((3-6))")[1] == "room-4"
    assert keys_of(spark, "step((98-101))") == ["step98", "step99", "step100", "step101"]
    assert keys_of(spark, '["((0000-0999))"]')[::999] == ['["0000"]', '["0999"]']
    assert keys_of(spark, '["day((01-02))",((10-14))]')[4] == '["day((01-02))",14]'
    assert keys_of(spark, "first;;third;") == ["first", "", "third"]
    assert keys_of(spark, '["n",((1-3))];["s",((1-4))]')[3] == '["s",1]'


def test_order_and_canonical_form(spark):
    rows = plan_keys(spark, '[ "a", 1 ];k((1-2));{"b":1, "a":2}').orderBy("key_ord").collect()
    assert [r["key_ord"] for r in rows] == [0, 1, 2, 3]
    assert [r["view_key"] for r in rows] == ['["a",1]', "k1", "k2", '{"a":2,"b":1}']


def test_a_range_longer_than_one_block(spark):
    keys = plan_keys(spark, "x;k((0-150000))").agg(
        F.count("*").alias("n"), F.countDistinct("key_ord").alias("d"), F.max("key_ord").alias("m")
    ).first()
    assert tuple(keys) == (150_002, 150_002, 150_001)


@pytest.mark.parametrize("n,m,chunks", [(7, 2, 2), (7, 4, 4), (7, 5, 4), (7, 9, 7), (5, 4, 3)])
def test_chunks(spark, n, m, chunks):
    found = plan_keys(spark, f"k((1-{n}))", num_chunks=m).collect()
    sizes = [sum(r["chunk_id"] == c for r in found) for c in range(chunks)]
    assert sum(sizes) == n and max(sizes) <= -(-n // m) and {r["chunk_id"] for r in found} == set(range(chunks))
    again = assign_chunks(plan_keys(spark, f"k((1-{n}))").drop("chunk_id"), n, m)
    assert sorted(r["chunk_id"] for r in again.collect()) == sorted(r["chunk_id"] for r in found)


def test_chunk_number_must_be_positive(spark):
    with pytest.raises(ValueError):
        plan_keys(spark, "a", num_chunks=0)


# Pieces that leave quotes and brackets closed, so that any of them joined by separators are the keys again.
CLOSED = st.one_of(
    st.text(alphabet="ab \n,", max_size=6),
    st.text(alphabet='ab;[]\n', max_size=6).map(lambda t: f'"{t}"x]'),
    st.text(alphabet="ab;\n", max_size=6).map(lambda t: f"[{t}]"),
    st.text(alphabet="ab;", max_size=6).map(lambda t: f'["{t}";{t}]'),
    st.sampled_from(['\\"', "\\[", "\\]", '"\\";"]', "[\\];]"]),
)
KEYS = st.lists(st.lists(CLOSED, min_size=1, max_size=4).map("".join), min_size=1, max_size=9)


@given(st.lists(KEYS, min_size=15, max_size=30))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_joined_keys_are_split_again(spark, lists):
    lists = [keys if keys[-1] else [*keys, "end"] for keys in lists]
    rows = spark.createDataFrame([(keys, ";".join(keys)) for keys in lists], "k array<string>, s string")
    for r in rows.select("k", "s", F.expr(split_key_spec("s")).alias("found")).collect():
        assert r["found"] == r["k"], r["s"]


@pytest.mark.parametrize("open_end", ['a;"b;c', "a;[b;c", 'a;["b];c'])
def test_an_open_end_is_one_key(spark, open_end):
    assert keys_of(spark, open_end) == [open_end[0], open_end[2:]]


def test_array_key_is_canonical(spark):
    texts = ["plain", 'q"uote', "back\\slash", "tab\tnewline\n", "\x01\x1f", "é/☃\U0001f600", "", "a;b[c]", None]
    df = spark.createDataFrame([(x, i - 4) for i, x in enumerate(texts)], "a string, b bigint")
    kinds = [f.dataType for f in df.schema]
    for key in (json_array_key([F.col("a"), F.col("b")], kinds), json_array_key([F.col("a"), F.col("b")])):
        row = df.select(key.alias("k")).select(
            "k", F.expr(canonical_key_sql("k")).alias("c"), F.to_json(F.try_parse_json("k")).alias("p")
        )
        assert all(r["k"] == r["c"] == r["p"] for r in row.collect())


MARK = "docloom-end-of-value"
# Text and its canonical form as JSON; None where it is not one JSON value.
JSON_TEXTS = {
    "0": "0", "12": "12", '"a"': '"a"', '"a\\u0041"': '"aA"', "[]": "[]", "[1,2]": "[1,2]", '["a", 1]': '["a",1]',
    "true": "true", "null": "null", " 1 ": "1", '{"b":1,"a":[1,  2]}': '{"a":[1,2],"b":1}', f'["{MARK}", 1]': f'["{MARK}",1]',
    "00": None, "nul": None, "x": None, "": None, '["a",01]': None, "[1,]": None, "1 x": None, "[1] x": None, '"a" b': None,
    "1,2": None, "1],[2": None, f'1,"{MARK}"],[2': None, '1},{"b":2': None, f'1,"{MARK}"': None, "{}}": None, "truely": None,
    f'1],["{MARK}"': None, f'1}},{{"{MARK}":2': None,
}


def test_only_whole_json_values_are_canonicalised(spark):
    df = spark.createDataFrame([(k,) for k in JSON_TEXTS], "k string")
    rows = df.selectExpr("k", f"{canonical_key_sql('k')} AS c", f"{is_json_sql('k')} AS j").collect()
    assert {r["k"]: r["c"] for r in rows} == {k: k if c is None else c for k, c in JSON_TEXTS.items()}
    assert {r["k"] for r in rows if r["j"]} == {k for k, c in JSON_TEXTS.items() if c is not None}
