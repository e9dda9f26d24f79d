import random

import pytest
from pyspark.sql import functions as F

from pricelens.functions.nulls import null_if_far, null_where_far
from pricelens.operators.cascade import best_offers, chained_cascade, match_rates, single_join_cascade, with_empty_offer
from pricelens.operators.joins import aligned_update, fill_missing_join, left_join_present, salt_table, skew_join
from pricelens.operators.nearest_value import nearest_value
from pricelens.operators.ranking import keep_best, last_write_wins, price_difference, rank_candidates
from pricelens.plans import match
from pricelens.plans.match import match_catalogues
from pricelens.plans.prepare import join_reference, prepare_catalogue
from pricelens.settings import JoinKey, Settings

KEYS = (JoinKey.of(("num", "Farbe"), ("art", "Farbe")), JoinKey.of("EAN"), JoinKey.of("maker"))


def toy(spark, values):
    return spark.createDataFrame(values, "A string, B double")


def test_fill_if_missing_cascade(spark, rows):
    left = toy(spark, [("1", 1.0), ("2", 2.0), ("3", None), ("4", 4.0), ("5", None), ("", None), ("", None)])
    second = toy(spark, [("1", 1234234.0), ("2", 2234234324.0), ("", 3223423.0), ("4", 4232323.0), ("5", 523323.0), ("6", 1212.0), ("7", None)])
    third = toy(spark, [("1", 1.0), ("2", 2.0), ("3", 3.0), ("4", 4.0), ("", 5.0), ("6", 6.0), ("7", 7.0)])
    filled = left.transform(fill_missing_join, second, "A", "A", "B", "B", "k1").transform(fill_missing_join, third, "A", "A", "B", "B", "k2")
    assert rows(filled, "A", "B", "Joined_on") == [
        (None, None, None), (None, None, None), ("1", 1.0, None), ("2", 2.0, None), ("3", 3.0, "k2"), ("4", 4.0, None), ("5", 523323.0, "k1"),
    ]
    near = filled.withColumn("B", null_if_far("B", F.col("A").cast("double"), 4))
    assert rows(near.where("A = '5'"), "B") == [(None,)]
    assert near.where("B is null").count() == 3


def test_fill_copies_all_columns_and_fans_out(spark, rows):
    left = spark.createDataFrame([("k", None, "old"), ("m", None, "old")], "k string, p double, t string")
    right = spark.createDataFrame([("k", 1.0, None), ("k", 2.0, "b"), ("m", None, "c")], "k string, p double, t string")
    filled = fill_missing_join(left, right, "k", "k", ["p", "t"], ["p", "t"], ["a", "b"])
    assert rows(filled, "k", "p", "t", "Joined_on") == [("k", 1.0, None, "a b"), ("k", 2.0, "b", "a b"), ("m", None, "old", None)]


def test_composite_key_matches_missing_with_missing(spark, rows):
    left = spark.createDataFrame([("k1", None), ("k1", "r"), (None, None)], "k string, f string")
    right = spark.createDataFrame([("k1", None, 5), (None, None, 9)], "k string, f string, p int")
    joined = left_join_present(left, right, ["k", "f"], ["k", "f"])
    assert rows(joined, "k", "f", "p___y") == [(None, None, None), ("k1", None, 5), ("k1", "r", None)]


def test_dead_rows_do_not_meet_in_one_task(spark):
    left = spark.range(4000).select(F.col("id"), F.lit(None).cast("string").alias("k"))
    right = spark.createDataFrame([("a", 1)], "k string, p int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = left_join_present(left, right, "k", "k").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


@pytest.mark.parametrize("task_rows", [10, 1000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_joins_keep_every_row(spark, rows, task_rows, how):
    big = spark.range(300).select("id", F.when(F.col("id") < 200, "hot").when(F.col("id") < 290, F.concat(F.lit("k"), "id")).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("k210", 2), ("none", 3)], "k string, v int")
    assert rows(skew_join(big, lookup, "k", how, task_rows)) == rows(big.join(lookup, "k", how))
    lookup = lookup.unionByName(spark.createDataFrame([("hot", 3), (None, 4)], "k string, v int"))
    assert rows(skew_join(big, lookup, "k", how, task_rows)) == rows(big.join(lookup, "k", how))


def test_salts_follow_the_rows_of_a_key(spark, rows):
    key = F.when(F.col("id") < 200, "hot").when(F.col("id") < 215, "warm").when(F.col("id") < 225, "cool")
    big = spark.range(1000).select("id", key.alias("k"), F.lit(1).alias("one"))
    assert rows(salt_table(big, ["k", "one"], 10)) == [("hot", 1, 20), ("warm", 1, 2)]  # 775 rows without a key take no place
    assert rows(salt_table(big, ["k", "one"], 10, buckets=1)) == [("hot", 1, 20), ("warm", 1, 2)]  # keys that share a bucket
    joined = skew_join(big, spark.createDataFrame([("hot", 1)], "k string, v int"), "k", "left", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 500


def random_catalogues(spark, seed=7):
    draw = random.Random(seed)

    def pick(n):
        return draw.choice([None, *map(str, range(n))])

    left = [(f"u{i}", pick(20), pick(3), pick(15), pick(5), float(draw.randint(1, 40))) for i in range(120)]
    right = [(draw.choice("XYZ"), f"r{i}", pick(20), pick(3), pick(15), pick(5), float(draw.randint(1, 40)), f"kurz{i}", f"lang{i}") for i in range(200)]
    main = spark.createDataFrame(left, "UID string, num string, Farbe string, EAN string, maker string, Preis double")
    other = spark.createDataFrame(right, "Konkurrenz string, UID string, art string, Farbe string, EAN string, maker string, Preis double, Art_Txt_Kurz string, Art_Txt_Lang string")
    return main, other


def test_single_join_cascade_equals_chain(spark, rows):
    main, other = random_catalogues(spark)
    right, left = other.where("Konkurrenz = 'X'"), with_empty_offer(main)
    columns = ("UID", "Preis_Konkurrenz", "Txt_Kurz_Konkurrenz", "Joined_on")
    assert rows(single_join_cascade(left, right, KEYS, "UID"), *columns) == rows(chained_cascade(left, right, KEYS), *columns)


def test_best_offers_equal_cascade_then_ranking(spark, rows):
    main, other = random_catalogues(spark)
    companies = {"X": KEYS, "Y": KEYS[1:], "Z": KEYS}
    expected = []
    for company, keys in companies.items():
        right = other.where(F.col("Konkurrenz") == company)
        matched = chained_cascade(with_empty_offer(main), right, keys).join(right.select(F.col("Art_Txt_Kurz").alias("Txt_Kurz_Konkurrenz"), F.col("UID").alias("rid")), "Txt_Kurz_Konkurrenz")
        best = keep_best(price_difference(matched.withColumn("Konkurrenz", F.lit(company))), tie="rid")
        expected += rows(best, "UID", "Konkurrenz", "Joined_on", "Preis_Konkurrenz", "rid")
    got = rows(best_offers(main, other, companies, "UID"), "UID", "Konkurrenz", "Joined_on", "Preis_Konkurrenz", "rid")
    assert got == sorted(expected)


def test_nearest_value_equals_brute_force(spark):
    draw = random.Random(3)
    offers = {(g, float(v)): f"{draw.randint(0, 99):02d}" for g in "ab" for v in (draw.randint(-500, 5000) / 4 for _ in range(150))}
    wanted = {(g, draw.randint(-600, 6000) / 4) for g in "abc" for _ in range(200)}
    got = nearest_value(
        spark.createDataFrame(list(wanted), "g string, v double"),
        spark.createDataFrame([(g, v, r) for (g, v), r in offers.items()], "g string, v double, rid string"), "g", "v", "rid",
    )
    expected = {}
    for g, v in wanted:
        options = [(abs(v - x), r, x) for (h, x), r in offers.items() if h == g]
        if options:
            expected[(g, v)] = (min(options)[2], min(options)[1])
    assert {(r.g, r.v): (r.near_value, r.rid) for r in got.collect()} == expected


def test_threshold_rank_and_best(spark, rows):
    frame = spark.createDataFrame([("a", 10.0, 9.0), ("a", 10.0, 12.0), ("b", 10.0, 2.0), ("c", 10.0, None)], "UID string, Preis double, Preis_Konkurrenz double")
    frame = price_difference(frame.withColumn("Konkurrenz", F.lit("X"))).transform(null_where_far, ["Preis_Konkurrenz"])
    assert rows(rank_candidates(frame), "UID", "Preisdifferenz", "Rank") == [("a", -2.0, 2), ("a", 1.0, 1), ("b", 8.0, 1), ("c", None, None)]
    assert rows(keep_best(frame), "UID", "Preisdifferenz", "Preis_Konkurrenz") == [("a", 1.0, 9.0), ("b", 8.0, None)]


def test_best_row_is_cut_before_the_shuffle(spark):
    frame = spark.range(100).select(F.col("id").cast("string").alias("UID"), F.lit("X").alias("Konkurrenz"), F.rand().alias("Preisdifferenz"))
    plan = keep_best(frame)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_last_write_wins(spark, rows):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, pos int, v string")
    assert rows(last_write_wins(frame, "k", "pos"), "k", "v") == [("a", "y"), ("b", "z")]


def test_aligned_update(spark, rows):
    left = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id int, x string, y string")
    right = spark.createDataFrame([(1, "A", None)], "id int, x string, y string")
    assert rows(aligned_update(left, right, "id", ["x", "y"])) == [(1, "A", "b"), (2, "c", "d")]


RAW = "ArtikelId string, FarbId string, `AusführungsId` string, Art_Nr_Hersteller string, Preis_EAN string, Art_Nr_EAN string, Preis_Pos string, AF_Txt string, AFZ_Txt string, Art_Txt_Kurz string, Art_Txt_Lang string"


def test_prepare(spark, rows):
    raw = spark.createDataFrame(
        [
            ("1001", None, None, "H12345", None, "76", "1.5", None, None, None, None), ("1001", None, None, "H12345", None, "76", "1.5", None, None, None, None),
            ("1002", "012", "L", "AB", "77", "76", "x", "rot", "links", None, None), ("1003", "", "", "A", None, None, None, None, None, None, None),
            ("1004", None, None, None, None, None, None, None, None, None, None),
        ],
        RAW,
    )
    assert rows(prepare_catalogue(raw), "UID", "Art_Nr_Hersteller", "Art_Nr_Hersteller_UID", "EAN", "Preis", "Farbe") == [
        ("1001000", "H12345", "H12345000", "76", 1.5, ""), ("1002012L", None, "AB012L", "77", None, "rot"), ("1003000", None, None, None, None, ""), ("1004000", None, None, None, None, ""),
    ]


def test_reference_number_is_cleaned_before_the_join(spark, rows):
    articles = spark.createDataFrame([("1", "x"), ("2", "y")], "ArtikelId string, t string")
    reference = spark.createDataFrame([("1", "12 34-5678", "010"), (None, "1", "020")], "Artikelnummer string, Konkurrenznummer string, Warengruppe string")
    assert rows(join_reference(articles, reference), "ArtikelId", "Konkurrenznummer", "Warengruppe") == [("1", "123456", "010"), ("2", None, None)]


def test_match_catalogues(spark, rows):
    def article(number, price, maker, ean, text):
        return (number, None, None, maker, None, ean, price, None, None, text, text)

    main = prepare_catalogue(spark.createDataFrame([
        article("1", "10", "maker1", None, "wc sitz weiss"), article("2", "10", None, "e2", "griff lang"), article("3", "10", None, None, "lampe rund gross"), article("4", "10", None, None, "nichts davon"),
        article("5", "10", "maker5", None, "teuer"),
    ], RAW))
    competitors = [
        ("X", *article("1", "9", None, None, "sitz")), ("X", *article("1", "8", "maker1", None, "anderes")), ("X", *article("72", "11", None, "e2", "griff")), ("X", *article("73", "12", None, None, "lampe rund gross neu")),
        ("X", *article("75", "100", "maker5", None, "x5")), ("Y", *article("82", "5.5", None, "e2", "griff")), ("Z", *article("1", "1", None, None, "andere firma")),
    ]
    other = spark.createDataFrame(competitors, "Konkurrenz string, " + RAW)
    keys = (JoinKey.of("UID"), JoinKey.of("EAN"), JoinKey.of("Art_Nr_Hersteller"))
    result = match_catalogues(main, prepare_catalogue(other), Settings("m", {"X": keys, "Y": keys}))
    assert rows(result, "ArtikelId", "Konkurrenz", "Preis_Konkurrenz", "Joined_on", "Preisdifferenz", "Txt_Kurz_Konkurrenz") == [
        ("1", "X", 9.0, "UID", 1.0, "sitz"), ("2", "X", 11.0, "EAN", -1.0, "griff"), ("2", "Y", 5.5, "EAN", 4.5, "griff"),
        ("3", "X", 12.0, "Text_Similarity", -2.0, "lampe rund gross neu"), ("5", "X", None, "Art_Nr_Hersteller", -90.0, "x5"),
    ]
    assert result.groupBy("UID", "Konkurrenz").count().where("count > 1").count() == 0
    everyone = match_catalogues(main, prepare_catalogue(other), Settings("m", {"X": keys, "Y": keys}), keep_unmatched=True)
    assert everyone.count() == 10
    rates = match_rates(result, main, {"X": keys, "Y": keys}).select("Konkurrenz", "Joined_on", "matched", "articles")
    assert rows(rates) == [
        ("X", "Art_Nr_Hersteller", 1, 3), ("X", "EAN", 1, 4), ("X", "Text_Similarity", 1, 2), ("X", "UID", 1, 5), ("Y", "EAN", 1, 5),
    ]


def test_rows_are_known_by_short_ids_and_meet_their_competitors_once(spark, rows, monkeypatch):
    """128 bits go through the shuffles of a match; a row's text is repeated for its open competitors after the join."""
    stored, write = {}, match.materialise
    monkeypatch.setattr(match, "materialise", lambda df, name: stored.setdefault(name, (df, write(df, name)))[1])
    article = ("1", None, None, "m1", None, "e1", "10", None, None, "rotes rad", "rotes rad")
    main = prepare_catalogue(spark.createDataFrame([article, ("2", *article[1:3], "m2", None, "e2", *article[6:])], RAW))
    other = prepare_catalogue(spark.createDataFrame([("X", "9", *article[1:]), ("Y", "8", *article[1:3], "m8", None, "e8", *article[6:])], "Konkurrenz string, " + RAW))
    keys = (JoinKey.of("EAN"),)
    result = match_catalogues(main, other, Settings("m", {"X": keys, "Y": keys}))
    assert rows(result, "ArtikelId", "Konkurrenz", "Joined_on") == [
        ("1", "X", "EAN"), ("1", "Y", "Text_Similarity"), ("2", "X", "Text_Similarity"), ("2", "Y", "Text_Similarity"),
    ]
    assert dict(stored["main"][1].dtypes)["row_id"] == "binary" and {len(r.row_id) for r in stored["main"][1].collect()} == {16}
    plan = stored["open-rows"][0]._jdf.queryExecution().optimizedPlan().toString()
    assert rows(stored["open-rows"][1], "Konkurrenz") == [("X",), ("Y",), ("Y",)]
    assert plan.index("Generate explode") < plan.index("Join")


def test_article_without_price_leaves_other_matches_alone(spark, rows):
    def article(number, price, text):
        return (number, None, None, None, None, None, price, None, None, text, text)

    other = prepare_catalogue(spark.createDataFrame([("X", *article("1", "9", "wc sitz weiss")), ("X", *article("7", "11", "lampe rund gross"))], "Konkurrenz string, " + RAW))
    for price in ("10", None):
        main = prepare_catalogue(spark.createDataFrame([article("1", price, "wc neu lampe anders"), article("2", "10", "lampe rund gross anders")], RAW))
        result = match_catalogues(main, other, Settings("m", {"X": (JoinKey.of("UID"),)}))
        assert ("2", "Text_Similarity", 11.0) in rows(result, "ArtikelId", "Joined_on", "Preis_Konkurrenz")


def test_composite_dead_rows_do_not_meet_in_one_task(spark):
    left = spark.range(4000).select(F.col("id"), F.lit(None).cast("string").alias("k"), F.lit(None).cast("string").alias("f"))
    right = spark.createDataFrame([("a", "b", 1)], "k string, f string, p int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = left_join_present(left, right, ["k", "f"], ["k", "f"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


def test_keys_are_compared_in_their_own_types(spark, rows):
    left = spark.createDataFrame([(1,), (2,)], "k long")
    right = spark.createDataFrame([(1.0, 5)], "k double, p int")
    assert rows(left_join_present(left, right, "k", "k"), "k", "p___y") == [(1, 5), (2, None)]


def test_rank_of_one_large_group(spark):
    frame = spark.range(2000).select(
        F.lit("one").alias("UID"), "id", F.when(F.col("id") % 10 != 0, (F.col("id") * 7919 % 200).cast("double")).alias("Preisdifferenz")
    )
    ranked = rank_candidates(frame, "UID", "id").collect()
    priced = sorted((r.Preisdifferenz, r.id) for r in ranked if r.Preisdifferenz is not None)
    assert {(r.Preisdifferenz, r.id): r.Rank for r in ranked if r.Rank is not None} == {k: i + 1 for i, k in enumerate(priced)}
    assert len(ranked) == 2000


def sort_merge_depth(df):
    """How many sort-merge joins lie on one path of the plan, at most."""
    path, deepest = [], 0
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        path = [i for i in path if i < indent] + ([indent] if "SortMergeJoin" in line else [])
        deepest = max(deepest, len(path))
    return deepest


@pytest.mark.parametrize("single", [False, True])
def test_matches_of_a_shared_key_are_not_shuffled_again(spark, rows, single):
    left = with_empty_offer(spark.range(60).select(F.col("id").cast("string").alias("UID"), F.concat(F.lit("e"), F.col("id") % 50).alias("EAN"), F.concat(F.lit("same"), F.col("id") % 1).alias("maker")))
    right = spark.range(40).select(
        F.concat(F.lit("e"), "id").alias("EAN"), F.concat(F.lit("same"), F.col("id") % 1).alias("maker"), F.col("id").cast("double").alias("Preis"),
        F.lit("k").alias("Art_Txt_Kurz"), F.lit("l").alias("Art_Txt_Lang"),
    )
    keys = [JoinKey.of("EAN"), JoinKey.of("maker")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = single_join_cascade(left, right, keys, "UID") if single else chained_cascade(left, right, keys)
        counts = rows(got.groupBy("Joined_on").count())
        depth = sort_merge_depth(got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts == [("EAN", 50), ("maker", 10 * 40)]
    assert depth == 1


def test_cascade_keys_with_empty_and_null_parts_match_once(spark, rows):
    left = with_empty_offer(spark.createDataFrame([("a", "n", ""), ("b", "n", None), ("c", None, ""), ("c", "x", "f")], "UID string, num string, Farbe string"))
    right = spark.createDataFrame([("n", "", 1.0), ("n", None, 2.0), (None, "", 3.0)], "art string, Farbe string, Preis double")
    right = right.withColumns({n: F.lit("t") for n in ("Art_Txt_Kurz", "Art_Txt_Lang")})
    got = chained_cascade(left, right, KEYS[:1])
    assert rows(got, "UID", "Preis_Konkurrenz") == [("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 2.0), ("c", None), ("c", None)]
