"""Column functions on golden rows."""

import pytest
from pyspark.sql import functions as F

from lotkeeper.functions import flags, numbers, text, times, urls


def apply(spark, function, inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


CASES = [
    (numbers.clean_price, ["RM 3,500", "rm 1,200", "negotiable", "3500.5", "3500.0", " 7 ", None,
                           "1e3", "", "12d", "-5"],
     [3500, 1200, None, None, 3500, 7, None, 1000, None, None, -5]),
    (numbers.clean_engine_capacity, ["1500cc", "250 cc", "1,500cc", "CC", None],
     [1500, 250, None, None, None]),
    (numbers.clean_year, ["1995 or older", "2019", "unknown", "Year 2020/2021", None],
     [1995, 2019, None, 2020, None]),
    (numbers.clean_flag, [" 1 ", "0", "yes", None], [1, 0, None, None]),
    (text.clean_text, ["y15ZR", "135lc", " mercedes-benz c-CLASS ", "nan", "it's", None, "éCOLE", "中a"],
     ["Y15Zr", "135Lc", "Mercedes-Benz C-Class", None, "It'S", None, "École", "中A"]),
    (text.clean_subject, ["Yamaha MT15 - Full Loan Ready Stock",
                          "Kawasaki Z250 - Low Deposit/ Free Delivery", "\U0001F600 中文 Vespa ", "nan",
                          "  ", None, "a\n- ready\nb", "NaN | ready"],
     ["Yamaha MT15", "Kawasaki Z250", "Vespa", None, None, None, "a\n- ready\nb", None]),
    (text.match_key, ["MT-15", None, "ç 1"], ["mt15", "", "1"]),
    (text.make_slug, ["Mercedes Benz", None], ["mercedes-benz", ""]),
    (text.model_slug, ["C-Class (W205)", " X "], ["c-class-w205", "x"]),
    (text.clean_placeholder, [" - ", "", " a ", None], [None, None, "a", None]),
    (numbers.leading_int, ["1,498 cc", "RM 89,900.00", "N/A", "5", "-", None],
     [1498, 89900, None, 5, None, None]),
    (numbers.leading_float, ["6.0 L/100 km", "11.0 seconds", "8.3", "tbc", "1,498.5"],
     [6.0, 11.0, 8.3, None, 1498.5]),
    (numbers.unit_int, ["1,250 mm", "795.5", "794.5 mm", "–", "none"], [1250, 796, 794, None, None]),
    (numbers.power_to_hp, ["12.8kW @ 8,000 RPM", "15.4 hp", "n/a", None], [17.2, 15.4, None, None]),
    (numbers.sqlite_integer, ["12500", "", "12abc", "abc", " -7", None], [12500, None, 12, 0, -7, None]),
    (flags.flag_from_text, ["true", " YES", "0", "", "maybe", None], [1, 1, 0, 0, None, None]),
    (flags.api_vehicle_type, ["Sedan", " Pick-Up ", "4 Wheels", None],
     ["Sedan", "Pickup / Truck", None, None]),
    (lambda c: times.time_text(times.parse_time(c)),
     ["2026-06-10 12:00:00", "2026-06-10T12:00", " 2026-06-10 ", "not-a-date", "", None, "2026-13-01",
      "2026-06-10 12"],
     ["2026-06-10 12:00:00", "2026-06-10 12:00:00", "2026-06-10 00:00:00", None, None, None, None,
      "2026-06-10 12:00:00"]),
    (lambda c: times.infer_sold(c, "2026-06-10 12:00:00"),
     ["2026-07-01 00:00:00", "2026-05-01 00:00:00", "2026-06-10 12:00:00", None, "not-a-date"],
     ["likely_sold", "likely_expired", "likely_expired", "unknown", "unknown"]),
    (urls.url_path, ["https://h.example.org/a/b/?x#y", "/a/b/", "http://h.example.org"], ["a/b", "a/b", ""]),
    (urls.is_spec_page, ["/x/specifications", "/ms/x/specifications", "/x"], [True, False, False]),
]


@pytest.mark.parametrize("function, inputs, expected", CASES)
def test_golden_rows(spark, function, inputs, expected):
    assert apply(spark, function, inputs) == expected


def test_hp_to_kw_rounds_half_to_even(spark):
    assert apply(spark, numbers.hp_to_kw, [100, None, 0], "int") == [75, None, 0]


@pytest.mark.parametrize("subject, make, model, token", [
    ("2020 Toyota ALPHARD 2.5 SC (A) ROOF ACC", "Toyota", "Alphard", "SC ROOF ACC"),
    ("Honda City 1.5 HATCHBACK V (A) 2022", "Honda", "City", "HATCHBACK V"),
    ("2010 Perodua MYVI 1.3 EZL (LIMITED EDITION) (A)", "Perodua", "Myvi", "EZL LIMITED"),
    ("Mazda (x) 3.\\E sport", "mazda", "(x) 3.\\E", "sport"),
    ("Proton Saga full loan", None, "", "Proton Saga"),
])
def test_variant_token(spark, subject, make, model, token):
    df = spark.createDataFrame([(subject, make, model)], "s string, a string, b string")
    assert df.select(text.variant_token(F.col("s"), F.col("a"), F.col("b"))).first()[0] == token


def test_mileage_bucket_sides(spark):
    df = spark.createDataFrame([(80000, 84999), (50000, None), (None, 9999), (None, None)],
                               "a long, b long")
    out = [r[0] for r in df.select(flags.mileage_bucket(F.col("a"), F.col("b"))).collect()]
    assert out == ["80000-84999", "50000-", "-9999", None]


@pytest.mark.parametrize("status, first_seen, checked, due", [
    ("available", "2026-06-07 12:00:00", None, True),
    ("available", "2026-06-07 12:00:00", "2026-06-09 17:00:00", False),
    ("available", "2026-06-07 12:00:00", "2026-06-09 15:00:00", True),
    ("available", "2026-05-21 12:00:00", "2026-06-08 12:00:00", False),
    ("available", "2026-05-21 12:00:00", "2026-06-07 12:00:00", True),
    ("available", "2026-03-12 12:00:00", "2026-06-04 12:00:00", False),
    ("available", "2026-03-12 12:00:00", "2026-06-03 12:00:00", True),
    ("unavailable", "2026-03-12 12:00:00", "2026-05-26 12:00:00", False),
    ("unavailable", "2026-03-12 12:00:00", "2026-05-28 12:00:00", True),
    ("unknown", None, "2026-06-09 15:00:00", True),
])
def test_cadence(spark, status, first_seen, checked, due):
    df = spark.createDataFrame([(first_seen, checked, status)], "f string, c string, s string")
    assert df.select(times.due_for_recheck(F.col("f"), F.col("c"), F.col("s"),
                                           "2026-06-10 12:00:00")).first()[0] is due


def test_variant_url_without_enough_segments_is_null(spark):
    df = spark.createDataFrame([("/a/b",), ("/honda/civic/fe/1.5-rs-2025",)], "u string")
    fields = urls.variant_url_fields(F.col("u"))
    rows = df.select(*[e.alias(c) for c, e in fields.items()]).collect()
    assert tuple(rows[0]) == (None,) * 5
    assert tuple(rows[1]) == ("honda", "civic", "fe", "1.5-rs", 2025)


def test_only_what_reads_as_an_integer_is_cast(spark):
    """A failed cast raises and catches an error for every row; the guard lets all pass that the cast reads."""
    from pyspark.sql import functions as F

    from lotkeeper.functions import numbers

    texts = ["12", "+12", "-0", " 12", "12\n", "\x0112\x7f", "\t+7 ", "", " ", "+", "1 2", "1.0", "x", "1,2", "9" * 18, "9" * 19, "9" * 40, "--1",
             "1-", "\u066112", "\u00a012", "0012", "12\n\n", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", numbers.plain_integer(F.col("t")).alias("a"), F.col("t").try_cast("bigint").alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]
    plan = rows.select(numbers.plain_integer(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN RLIKE" in plan
