import pytest

from matchlake.functions import shape


def test_flatten_nested_and_clash(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('b', named_struct('c', 2, 'd', array(3))) AS a")
    assert shape.flatten(df).columns == ["id", "a_b_c", "a_b_d"]
    assert shape.flatten(df, ".").columns == ["id", "a.b.c", "a.b.d"]
    clash = spark.sql("SELECT 1 AS a_b, named_struct('b', 2) AS a")
    with pytest.raises(ValueError, match="flatten to a_b"):
        shape.flatten(clash)
    # names that differ only in case clash too, since Spark resolves them alike
    with pytest.raises(ValueError):
        shape.flatten(spark.sql("SELECT 1 AS A_B, named_struct('b', 2) AS a"))


def test_flatten_names_with_dots(spark, rows):
    df = spark.sql("SELECT named_struct('x.y', 1) AS `a.b`")
    flat = shape.flatten(df)
    assert flat.columns == ["a.b_x.y"] and rows(flat) == [(1,)]


def test_null_struct_gives_null_leaves(spark, rows):
    df = spark.sql("SELECT CAST(NULL AS struct<b: int>) AS a UNION ALL SELECT named_struct('b', 1)")
    assert rows(shape.flatten(df)) == [(1,), (None,)]


def test_tag_overwrites(spark):
    df = shape.tag(spark.sql("SELECT 'x' AS competition_code, named_struct('y', 1) AS season"), competition_code="PL", season=2023)
    assert df.first().asDict() == {"competition_code": "PL", "season": 2023}


def test_encode_keeps_nulls(spark):
    df = spark.sql(
        "SELECT named_struct('a', CAST(NULL AS int), 'b', 'é\"') AS s, array(1, NULL) AS l, map('k', 1) AS m, "
        "CAST(NULL AS array<int>) AS n, 'text' AS t, 5 AS i"
    )
    got = shape.encode_complex(df).first().asDict()
    assert got == {"s": '{"a":null,"b":"é\\""}', "l": "[1,null]", "m": '{"k":1}', "n": None, "t": "text", "i": 5}


def test_encode_strict(spark, rows):
    df = spark.sql(
        "SELECT * FROM VALUES (1, array(1, NULL)), (2, array(CAST(NULL AS int))), (3, CAST(array() AS array<int>)), "
        "(4, CAST(NULL AS array<int>)) AS t(id, l)"
    )
    assert rows(shape.encode_strict(df)) == [(1, "[1,null]"), (2, None), (3, None), (4, None)]
    one = spark.sql("SELECT array(double('nan')) AS f, DATE '2024-01-02' AS d, named_struct('a', 1) AS s, 'x' AS t, 2 AS i")
    assert shape.encode_strict(one).first().asDict() == {"f": None, "d": "2024-01-02", "s": '{"a":1}', "t": "x", "i": 2}


def test_json_columns_are_sniffed_and_typed(spark, rows):
    df = spark.createDataFrame(
        [(1, None, "plain", None), (2, '{"k": 1}', "{later", None), (3, "{broken", "x", None)],
        "id int, j string, t string, n string",
    ).coalesce(1)
    assert shape.json_columns(df) == ["j"]
    typed = shape.promote_json(df)
    assert dict(typed.dtypes)["j"] == "variant" and dict(typed.dtypes)["t"] == "string"
    # text that does not parse is still there
    assert rows(typed.selectExpr("id", "CAST(j AS string)")) == [(1, None), (2, '{"k":1}'), (3, "{broken")]
