import pytest

from tradewind.functions.names import normalize_columns, normalize_header, normalize_name


@pytest.mark.parametrize("raw, name", [
    ("Preço (R$)", "preco_r"), ("2nd col", "col_2nd_col"), ("__a--b__", "a_b"), ("ÉTÉ", "ete"),
    ("﻿id", "id"), ("created_at", "created_at"), ("日本", ""),
])
def test_name(raw, name):
    assert normalize_name(raw) == name


def test_repeated_and_empty_names():
    assert normalize_header(["a", "A", "a_1", "á", "", "?"]) == ["a", "a_1", "a_1_1", "a_2", "col_5", "col_6"]


def test_columns_keep_rows(spark):
    df = normalize_columns(spark.createDataFrame([(1, 2)], "`Código` int, `codigo ` int"))
    assert df.columns == ["codigo", "codigo_1"] and tuple(df.first()) == (1, 2)
