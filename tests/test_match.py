"""Catalog matching: golden cases and brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rows import values
from lotkeeper.operators import match, types, variants

CAR = ("cat_id int, make string, model string, year int, engine_cc int, power_hp int, "
       "torque_nm int, length_mm int, seats int, body_type string, engine_tech string")
CARS = [
    (1, "honda", "city", 2014, 1497, 120, 145, 4440, 5, "Sedan", "i-VTEC"),
    (2, "honda", "city", 2020, 1498, 121, 145, 4553, 5, "Sedan", "i-VTEC"),
    (3, "mercedes-benz", "c-class", 2015, 1991, 184, 300, 4686, 5, "Sedan", None),
    (4, "mercedes-benz", "c-class", 2016, 1991, 245, 370, 4686, 5, "Sedan", None),
    (5, "toyota", "corolla-altis", 2019, 1798, 139, 172, 4630, 5, "Sedan", None),
]


def car_tiers(spark, rows, catalog=CARS, alias=(("Toyota|Altis", "corolla-altis"),)):
    keys = spark.createDataFrame(rows, "make string, model string, cc int, year int")
    aliases = spark.createDataFrame(list(alias), "alias string, slug string")
    found = match.match_cars(keys, spark.createDataFrame(catalog, CAR), model_alias=aliases)
    return {(r.make, r.model, r.cc, r.year): (r.tier, r.row.cat_id if r.row else None)
            for r in found.collect()}


@pytest.mark.parametrize("key, expected", [
    (("Honda", "City", 1500, 2020), ("cc_full", 2)),
    (("Honda", "City", 1500, 2017), ("cc_full", 1)),
    (("Honda", "City", 1500, None), ("cc_full", 1)),
    (("Mercedes Benz", "C-Class", 1991, 2016), ("cc_dims", 4)),
    (("Honda", "City", 3000, 2020), ("null", None)),
    (("Honda", "City", None, 2020), ("null", None)),
    (("Honda", "Zxyzzy", 1500, 2020), ("no_model", None)),
    (("Ferrari", "F40", 2900, 1990), ("no_make_catalog", None)),
    (("Toyota", "Altis", 1800, 2019), ("cc_full", 5)),
    ((None, None, 1800, 2019), ("no_make_catalog", None)),
])
def test_car_tiers(spark, key, expected):
    assert car_tiers(spark, [key])[key] == expected


def test_cars_against_brute_force(spark):
    rng = random.Random(7)
    year = lambda: rng.choice([None, *range(1998, 2004)])
    catalog = [(i, f"m{rng.randrange(2)}", f"x-{rng.randrange(3)}", year(),
                rng.choice([None, *range(960, 1200, 30)]), rng.choice([None, 90, 100, 105, 130]),
                1, 1, 1, "b", None) for i in range(60)]
    keys = list({(f"M{rng.randrange(3)}", f"X {rng.randrange(4)}",
                  rng.choice([None, *range(940, 1240, 25)]), year()) for _ in range(150)})
    got = car_tiers(spark, keys, catalog, [("none", "none")])
    norm = lambda s: re.sub("[^a-z0-9]", "", s.lower())
    for make, model, cc, yr in keys:
        pool = [r for r in catalog if r[1] == make.lower()]
        rows = [r for r in pool if norm(r[2]) == norm(model)]
        near = [r for r in rows if cc is not None and r[4] is not None and abs(r[4] - cc) <= 50]
        if not pool:
            want = ("no_make_catalog", None)
        elif not rows:
            want = ("no_model", None)
        elif not near:
            want = ("null", None)
        else:
            best = min(near, key=lambda r: (1, 0, r[0]) if r[3] is None or yr is None
                       else (0, abs(r[3] - yr), r[0]))
            powers = [r[5] for r in near if r[5] is not None]
            sure = bool(powers) and max(powers) <= min(powers) * 1.10
            want = ("cc_full" if sure else "cc_dims", best[0])
        assert got[(make, model, cc, yr)] == want


def test_fill_cars_keeps_own_engine_size_and_skips_filled_rows(spark):
    ads = spark.createDataFrame(
        [(1, "Honda", "City", 1500, 2020, None, None, None, None, None, None),
         (2, "Mercedes Benz", "C-Class", 1991, 2016, None, None, 9, 9, None, None),
         (3, "Honda", "City", 1500, 2020, 7, None, None, None, None, None),
         (4, "Honda", "City", 9000, 2020, None, 3, None, None, None, None),
         (200_000_000, "Honda", "City", 1500, 2020, None, None, None, None, None, None)],
        "ads_id long, make string, model string, engine_capacity int, manufactured_date int, "
        "engine_cc int, length_mm int, peak_power_kw int, peak_torque_nm int, spec_match string, "
        "spec_source string")
    out = match.enrich_cars(ads, spark.createDataFrame(CARS, CAR), "cat")
    assert values(out, "ads_id", "engine_cc", "length_mm", "peak_power_kw", "peak_torque_nm",
                  "spec_match", "spec_source") == [
        (1, 1500, 4553, 90, 145, "cc_full", "cat"), (2, 1991, 4686, None, None, "cc_dims", "cat"),
        (200_000_000, None, None, None, None, None, None), (3, 7, None, None, None, None, None),
        (4, None, 3, None, None, "null", None)]


def moto(spark, pairs, catalog, alias=()):
    keys = spark.createDataFrame(pairs, "motorcycle_make string, motorcycle_model string")
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(catalog)],
                                 "cat_id int, make string, model string")
    aliases = spark.createDataFrame(list(alias), "alias string, slug string") if alias else None
    out = match.match_motorcycles(keys, rows, model_alias=aliases)
    return {(r[0], r[1]): (r.tier, r.catalog_key) for r in out.select(
        "motorcycle_make", "motorcycle_model", "tier", "catalog_key").collect()}


def test_motorcycle_tiers(spark):
    catalog = [("yamaha", "nvx"), ("yamaha", "135lc-fi"), ("yamaha", "mt-15"), ("yamaha", "mt-25"),
               ("solo", "one")]
    got = moto(spark, [("Yamaha", "Nvx"), ("Yamaha", "135Lc"), ("Yamaha", "Mt"), ("Yamaha", "R25"),
                       ("Ducati", "X"), ("Yamaha", "Zxyzzy"), ("Solo", ""), ("Yamaha", None)],
               catalog, [("Yamaha|R25", "mt-25"), ("Yamaha|Mt", "nope")])
    assert got == {
        ("Yamaha", "Nvx"): ("exact", "nvx"), ("Yamaha", "135Lc"): ("prefix", "135lcfi"),
        ("Yamaha", "Mt"): ("null", None), ("Yamaha", "R25"): ("alias", "mt25"),
        ("Ducati", "X"): ("no_make_catalog", None), ("Yamaha", "Zxyzzy"): ("null", None),
        ("Solo", ""): ("prefix", "one"), ("Yamaha", None): ("null", None)}


def test_prefix_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randrange(0, 5)))
    catalog = sorted({(f"m{rng.randrange(3)}", word()) for _ in range(18)})
    pairs = sorted({(f"M{rng.randrange(3)}", word()) for _ in range(40)})
    got = moto(spark, pairs, catalog)
    for make, model in pairs:
        pool = [k for m, k in catalog if m == make.lower()]
        hits = [k for k in pool if k.startswith(model) or model.startswith(k)]
        want = (("no_make_catalog", None) if not pool else ("exact", model) if model in pool
                else ("prefix", hits[0]) if len(hits) == 1 else ("null", None))
        assert got[(make, model)] == want, (make, model, pool)


def test_car_types_api_first_then_mapping(spark):
    ads = spark.createDataFrame(
        [(1, "Proton", "Saga", "Sedan"), (2, "Suzuki", "Jimny", "4 Wheels"),
         (3, "suzuki", "jimny", "Others"), (4, "Newbrand", "Mystery", "Others"),
         (5, "Toyota", "Hilux", "Pick-Up")], "ads_id int, make string, model string, car_type string"
    ).withColumns({"vehicle_type": F.lit(None).cast("string"), "type_group": F.lit(None).cast("string")})
    rows = spark.createDataFrame([("Suzuki", "Jimny ", "Sedan", 1), (" suzuki", "jimny",
                                                                    "SUV / Crossover", 2)],
                                 "make string, model string, type string, pos int")
    mapping = types.type_mapping(rows, "cars", "pos")
    assert types.enrich_stats(ads, mapping).first().asDict() == {
        "candidates": 5, "filled_api": 2, "filled_mapping": 2, "unresolved": 1, "unmapped_pairs": 1}
    assert values(types.fill_car_types(ads, mapping), "ads_id", "vehicle_type", "type_origin")[1] == (
        2, "SUV / Crossover", "mapping")
    with pytest.raises(Exception, match="unknown type Spaceship"):
        types.type_mapping(rows.withColumn("type", F.lit("Spaceship")), "cars", "pos").collect()


def test_stubs_are_added_once_and_sorted(spark):
    rows = spark.createDataFrame([("Honda", "Ex5", "Scooter", "m", "", "", "Verified")],
                                 "make string, model string, type string, classification_method string,"
                                 "evidence string, source_url string, verification_status string")
    pairs = spark.createDataFrame([("honda", "EX5"), ("Aveta", "Nova"), ("AVETA ", "nova"), ("", "x"),
                                   (None, "y")], "make string, model string")
    once = types.stub_unmapped(pairs, rows)
    assert [(r.make, r.model, r.verification_status) for r in once.collect()] == [
        ("AVETA", "nova", "Auto-stub"), ("Honda", "Ex5", "Verified")]
    assert values(types.stub_unmapped(pairs, once)) == values(once)


def test_longest_variant_wins_and_empty_list_falls_through(spark):
    vocabulary = spark.createDataFrame(
        [("myvi", {"1500": ["G", "GR Sport"], "1300": []}, ["EZ", "X"])],
        "model_slug string, by_cc map<string,array<string>>, all_tokens array<string>")
    ads = spark.createDataFrame(
        [(1, "Myvi", 1500, "myvi gr sport", None, "KL"), (2, "Myvi", 1300, "Myvi EZ", None, "KL"),
         (3, "Myvi", 1500, "myvi gr sport", None, None), (4, "Myvi", None, "x", None, "KL"),
         (5, "Myvi", 1500, "g", "kept", "KL")],
        "ads_id int, model string, engine_capacity int, subject string, variant string, region string")
    assert values(variants.fill_variants(ads, vocabulary), "ads_id", "variant") == [
        (1, "GR Sport"), (2, "EZ"), (3, None), (4, "X"), (5, "kept")]
