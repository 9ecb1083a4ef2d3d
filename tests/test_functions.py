"""Column rules on small hand-written cells."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata import functions as rules
from lodestrata.plans import catalogue as c


def run(spark, cells, rule, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cells)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(rule("v")).collect()]


def test_safe_number_int(spark):
    cells = ["108", "texto", None, "99999999999", "2147483647", " 7 ", "1.5", "-3"]
    assert run(spark, cells, lambda v: rules.safe_number(v, "int")) == [
        108, None, None, None, 2147483647, 7, None, -3,
    ]


def test_safe_number_double(spark):
    cells = ["8.4", "8,4", None, "1e5", "NaN", ".5", "-2", '28"', ""]
    assert run(spark, cells, rules.safe_number) == [8.4, None, None, None, None, None, -2.0, None, None]


def test_decimal_comma_only_changes_whole_numbers(spark):
    cells = ["208,19", "31.842", "told in 1987, 1994 and 2003.7", " 41,562 ", None]
    assert run(spark, cells, rules.decimal_comma) == [
        "208.19", "31.842", "told in 1987, 1994 and 2003.7", "41.562", None,
    ]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("58000000", "58000000.00"),
        ("Unknown", None),
        ("$1,200,000.50", "1200000.50"),
        ("$ 97000000", "97000000.00"),
        ("USD 150000000", "150000000.00"),
        ("us$ 15", "15.00"),
        ("R$ 10.5", "10.50"),
        ("€7", "7.00"),
        ("34.0M", "34000000.00"),
        ("250.5K", "250500.00"),
        ("1.5b", "1500000000.00"),
        ("1.234567M", "1234567.00"),
        ("N/A", None),
        ("Não Informado", None),
        ("lancado em 2013 e 2017", None),
        ('a 9" fim', None),
        ("-5", None),
        ("1,20", None),
        ("12345678901234567", None),
        ("9999999999999999B", None),
        ("9999999999999999", "9999999999999999.00"),
        ("9999999999999999.999", None),
        ("", None),
        (None, None),
    ],
)
def test_money(spark, text, expected):
    want = None if expected is None else Decimal(expected)
    assert run(spark, [text], rules.money) == [want]


def test_money_type(spark):
    df = spark.createDataFrame([("1",)], "v string").select(rules.money("v").alias("m"))
    assert df.schema["m"].dataType.simpleString() == "decimal(18,2)"


def test_multi_date(spark):
    cells = [
        "2016-02-09", "04-25-2018", "data-invalida", "23/05/2022", "31/02/2022", "", None, "2022",
        "25-04-2018", " 2020-01-31 ", "2020-02-30",
    ]
    assert run(spark, cells, rules.multi_date) == [
        date(2016, 2, 9), date(2018, 4, 25), None, date(2022, 5, 23), None, None, None, None,
        None, date(2020, 1, 31), None,
    ]


def test_year_keeps_null(spark):
    assert run(spark, ["2016-02-09", None], lambda v: F.year(rules.multi_date(v))) == [2016, None]


def test_normalize_label(spark):
    cells = ["  released-", "POST PRODUCTION", "-Planned-", "Post  Production", "- released -", None]
    assert run(spark, cells, rules.normalize_label) == [
        "RELEASED", "POST PRODUCTION", "PLANNED", "POST PRODUCTION", " RELEASED ", None,
    ]


def test_map_values(spark):
    cells = ["RELEASED", "CANCELED", "XYZ123", None]
    got = run(spark, cells, lambda v: rules.map_values(v, c.STATUS_LABELS, c.UNKNOWN_STATUS))
    assert got == ["Lançado", "Cancelado", "Não Informado", "Não Informado"]


def test_null_outside(spark):
    cells = [8.5, 76.06, -1.0, 0.0, 10.0, None]
    assert run(spark, cells, lambda v: rules.null_outside(v, 0, 10), "double") == [
        8.5, None, None, 0.0, 10.0, None,
    ]
    assert run(spark, [100, -5, 0], lambda v: rules.null_outside(v, 0), "int") == [100, None, 0]
    assert run(spark, [100, 5], lambda v: rules.null_outside(v, high=10), "int") == [None, 5]


def test_null_non_positive(spark):
    assert run(spark, [100.0, 0.0, -50.0, None], rules.null_non_positive, "double") == [
        100.0, None, None, None,
    ]


def test_is_not_number_ignores_blank_cells(spark):
    cells = ["Danish", "", "  ", None, "7.5", "100"]
    assert run(spark, cells, rules.is_not_number) == [True, False, False, False, False, False]
    assert run(spark, ["100.0", "100"], lambda v: rules.is_not_number(v, "int")) == [True, False]


def test_null_when(spark):
    got = run(spark, [1, 2, None], lambda v: rules.null_when(v, F.col("v") == 2), "int")
    assert got == [1, None, None]


def test_default_blank(spark):
    cells = ["bom filme", "   ", None, "", "\t"]
    assert run(spark, cells, lambda v: rules.default_blank(v, c.NO_COMMENT)) == [
        "bom filme", "Sem comentário", "Sem comentário", "Sem comentário", "\t",
    ]


def test_split_list_unifies_separators(spark):
    cells = ["Action; Adventure", "Comedy|Drama", "A , B;C|D", None]
    assert run(spark, cells, rules.split_list) == [
        ["Action", "Adventure"], ["Comedy", "Drama"], ["A", "B", "C", "D"], None,
    ]


def test_strip_edges(spark):
    cells = ["\\petra Lindqvist", 'Ivo Brandt"', ' "x" ', "D'Amico"]
    assert run(spark, cells, rules.strip_edges) == ["petra Lindqvist", "Ivo Brandt", "x", "D'Amico"]


def test_is_name(spark):
    cells = [
        "6.1", "766", "/pic77.jpg", "poster.PNG", "X", "y" * 61, "N/A", "", None, "None", "n/a",
        "Tom Hollis", "y" * 60, "Jo", "3,5",
    ]
    assert run(spark, cells, rules.is_name) == [False] * 11 + [True, True, True, False]


def test_title_case_words(spark):
    cells = [
        "Nora D'Amico", "Lia DeRossi", "edda McTavish", "TOM HOLLIS",
        "tom hollis", "QZX", "ANNE-LISE", None,
    ]
    assert run(spark, cells, rules.title_case_words) == [
        "Nora D'Amico", "Lia DeRossi", "Edda McTavish", "Tom Hollis",
        "Tom Hollis", "Qzx", "Anne-lise", None,
    ]


def test_convert_currency(spark):
    got = run(spark, [Decimal(100), Decimal(200), None], lambda v: rules.convert_currency(v, 5), "decimal(18,2)")
    assert got == [500.0, 1000.0, None]


def test_margin_percent(spark):
    rows = [(100, 200), (None, 200), (100, None), (0, 5), (300, 100)]
    df = spark.createDataFrame(
        [(i, None if b is None else Decimal(b), None if r is None else Decimal(r)) for i, (b, r) in enumerate(rows)],
        "i int, b decimal(18,2), r decimal(18,2)",
    )
    out = df.orderBy("i").select(rules.margin_percent("r", "b").alias("m"), rules.profit("r", "b").alias("p"))
    assert [r["m"] for r in out.collect()] == [Decimal("100.00"), None, None, None, Decimal("-66.67")]
    assert out.schema["m"].dataType.simpleString() == "decimal(26,2)"
    assert out.schema["p"].dataType.simpleString() == "decimal(19,2)"


def test_margin_of_extreme_amounts_does_not_fail(spark):
    df = spark.createDataFrame([(Decimal("0.01"), Decimal("9999999999999999.99"))], "b decimal(18,2), r decimal(18,2)")
    assert len(df.select(rules.margin_percent("r", "b")).collect()) == 1
