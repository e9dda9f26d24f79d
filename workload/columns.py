"""Checks of projections, predicates, null handling and scalar functions."""

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricelens.functions import nulls as N
from pricelens.functions import text as X
from pricelens.operators.joins import drop_suffixed
from pricelens.operators.outliers import outlier_review
from pricelens.operators.ranking import price_difference
from pricelens.operators.reshape import companies_of, pivot_offers
from workload import roles as R
from workload.registry import query
from workload.roles import sql, table


@query("P1_missing_predicate", sql('SELECT "ArtikelId", "FarbId" IS NULL AS one, "FarbId" IS NULL AND "AusführungsId" IS NULL AS all_of, "FarbId" IS NULL OR "AusführungsId" IS NULL AS any_of FROM main_raw', "main_raw"))
def _(spark, sf):
    return R.main_raw(spark, sf).select(
        "ArtikelId", N.is_missing("FarbId").alias("one"),
        N.missing(["FarbId", "AusführungsId"]).alias("all_of"),
        N.missing(["FarbId", "AusführungsId"], "any").alias("any_of"),
    )


@query("P2_null_spellings", "SELECT p_partkey, CASE WHEN p_type = 'STANDARD' THEN NULL WHEN p_type = 'SMALL' THEN NULL WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS kind FROM part")
def _(spark, sf):
    spelled = F.when(F.col("p_type") == "STANDARD", "None").when(F.col("p_type") == "SMALL", "[None]").when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type"))
    return N.normalise_nulls(table(spark, sf, "part").select("p_partkey", spelled.alias("kind")))


@query("P3_first_present", sql('SELECT "ArtikelId", coalesce("Preis_EAN", "Art_Nr_EAN") AS "EAN", coalesce("AFZ_Txt", \'\') AS "Ausführung" FROM main_raw', "main_raw"))
def _(spark, sf):
    return R.main_raw(spark, sf).select(
        "ArtikelId", F.coalesce("Preis_EAN", "Art_Nr_EAN").alias("EAN"), N.null_to_blank("AFZ_Txt").alias("Ausführung")
    )


@query("P4_column_order", "SELECT p_name, p_partkey FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_name", "p_partkey")


@query("P5_drop_helper_columns", "SELECT l_orderkey, l_linenumber FROM lineitem")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_tax").alias("l_tax___y"))
    return drop_suffixed(lines)


@query("P6_rename", 'SELECT p_partkey AS "Artikelnummer", p_type AS "Category_Level_1" FROM part')
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_type").toDF("Artikelnummer", "Category_Level_1")


@query("P7_competitor_columns", sql('SELECT "Konkurrenz" AS company, count("Preis") AS priced FROM competitor GROUP BY ALL', "competitor"))
def _(spark, sf):
    offers = R.competitor_raw(spark, sf).select("ArtikelId", "FarbId", "Konkurrenz", F.col("Preis_Pos").cast("double").alias("Preis_Konkurrenz"))
    # article numbers of a competitor have six digits, so several articles may share one: the key tells them apart
    nth = F.row_number().over(Window.partitionBy("Konkurrenz", "ArtikelId", "FarbId").orderBy("Preis_Konkurrenz"))
    keyed = offers.withColumn("UID", F.concat_ws("/", "ArtikelId", F.coalesce("FarbId", F.lit("")), nth.cast("string")))
    wide = pivot_offers(keyed, R.COMPANIES, "Preis_Konkurrenz")
    found = companies_of(wide.columns)
    counts = wide.agg(*(F.count(f"Preis_Konkurrenz_{c}").alias(c) for c in found))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("company"), F.col(c).alias("priced")) for c in found))).alias("e")).select("e.*")


@query("P8_constant_columns", "SELECT c_custkey, 'main' AS \"Konkurrenz\", NULL::double AS \"Preis_Konkurrenz\" FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.lit("main").alias("Konkurrenz"), F.lit(None).cast("double").alias("Preis_Konkurrenz")
    )


@query("P9_lenient_number", "SELECT p_partkey, try_cast(replace(p_brand, 'Brand#1', '') AS double) AS number FROM part")
def _(spark, sf):
    text = F.replace("p_brand", F.lit("Brand#1"), F.lit(""))
    return table(spark, sf, "part").select("p_partkey", text.alias("t")).select("p_partkey", N.as_number("t").alias("number"))


@query("P10_conditional_update", "SELECT p_partkey, CASE WHEN p_size > 40 THEN 'large' ELSE p_type END AS kind FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") > 40, "large").otherwise(F.col("p_type")).alias("kind"))


@query("P11_null_if_far", "SELECT l_orderkey, l_linenumber, CASE WHEN abs(l_extendedprice / l_quantity - 1000) > 500 THEN NULL ELSE l_extendedprice / l_quantity END AS price FROM lineitem")
def _(spark, sf):
    priced = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    return priced.withColumn("price", N.null_if_far("price", F.lit(1000.0), 500))


@query("P12_null_where_share_exceeds", 'SELECT l_orderkey, l_linenumber, 1000.0::double AS "Preis", 1000 - l_extendedprice / l_quantity AS "Preisdifferenz", CASE WHEN abs((1000 - l_extendedprice / l_quantity) / 1000) > 0.5 THEN NULL ELSE l_extendedprice / l_quantity END AS "Preis_Konkurrenz" FROM lineitem')
def _(spark, sf):
    priced = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit(1000.0).alias("Preis"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("Preis_Konkurrenz")
    )
    return N.null_where_far(price_difference(priced), ["Preis_Konkurrenz"], 0.5)


@query("P13_row_filter", "SELECT p_partkey, p_name FROM part WHERE p_size > 20 AND p_retailprice < 1000")
def _(spark, sf):
    return table(spark, sf, "part").where("p_size > 20 and p_retailprice < 1000").select("p_partkey", "p_name")


@query("P14_drop_missing_rows", sql('SELECT "FarbId", "AusführungsId" FROM main_raw WHERE "FarbId" IS NOT NULL OR "AusführungsId" IS NOT NULL', "main_raw"))
def _(spark, sf):
    return R.main_raw(spark, sf).select("FarbId", "AusführungsId").dropna("all")


@query("P15_text_lacks_word", "SELECT p_partkey, p_name FROM part WHERE NOT contains(lower(p_name), 'anvil')")
def _(spark, sf):
    return table(spark, sf, "part").where(X.lacks("p_name", "Anvil")).select("p_partkey", "p_name")


@query("P16_membership", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@query("P17_sql_where", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag > '' AND l_linestatus = 'O' AND l_returnflag <> 'R' AND l_shipdate > DATE '2000-08-01'")
def _(spark, sf):
    return spark.sql(
        "SELECT l_orderkey, l_linenumber FROM {lines} WHERE l_returnflag > '' AND l_linestatus = 'O' AND l_returnflag <> 'R' AND l_shipdate > add_months(:as_of, -12)",
        args={"as_of": date(2001, 8, 1)}, lines=table(spark, sf, "lineitem"),
    )


@query("P18_outlier_review_rows", 'SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 5 AND l_returnflag <> \'R\'')
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_quantity") > 5, F.col("l_extendedprice")).alias("Preis_Konkurrenz_A"),
        F.when(F.col("l_returnflag") == "R", "Text_Similarity").when(F.col("l_returnflag") == "A", "EAN").alias("Joined_on_A"),
    )
    return outlier_review(rows, "A").select("l_orderkey", "l_linenumber")


@query("F1_unique_id", sql('SELECT "ArtikelId", CASE WHEN "FarbId" IS NULL OR "AusführungsId" IS NULL THEN "ArtikelId" ELSE "ArtikelId" || "FarbId" || "AusführungsId" END AS "UID" FROM main_raw', "main_raw"))
def _(spark, sf):
    return R.main_raw(spark, sf).select("ArtikelId", X.unique_id("ArtikelId", "FarbId", "AusführungsId").alias("UID"))


@query("F2_join_list", "SELECT p_partkey, array_to_string([p_name, p_type], ' ') AS joined, p_name || p_type AS tight FROM part")
def _(spark, sf):
    both = F.array("p_name", "p_type")
    return table(spark, sf, "part").select("p_partkey", X.join_list(both).alias("joined"), X.join_list(both, "").alias("tight"))


@query("F3_null_if_shorter", "SELECT p_partkey, CASE WHEN length(p_partkey::varchar) < 3 THEN NULL ELSE p_partkey::varchar END AS number FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.null_if_shorter(F.col("p_partkey").cast("string"), 3).alias("number"))


@query("F4_clean_number", "SELECT c_custkey, substring(regexp_replace(c_name, '[^0-9]', '', 'g'), 1, 6) AS number FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.clean_number("c_name").alias("number"))


@query("F5_clean_text", "SELECT doc_id, trim(replace(replace(replace(text, chr(13), ''), chr(10), ' '), '\"', ''), E' \\t\\r\\n\\f\\v') AS text FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_text("text").alias("text"))


@query("F6_repair_dos_text", "SELECT doc_id, replace(text, '&', ' & ') AS text FROM documents")
def _(spark, sf):
    broken = F.translate("text", X.DOS_LETTERS, X.DOS_BYTES)
    return table(spark, sf, "documents").select("doc_id", X.repair_dos_text(broken).alias("text"))


@query("F7_brand_flag", "SELECT doc_id, contains(replace(lower(text), ' ', ''), 'andthe') AS flag FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.mentions("text", "andthe").alias("flag"))


@query("F8_substring", "SELECT c_custkey, substring(c_name, 2, 500) AS name FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.substring("c_name", 2, 500).alias("name"))


_FILE = "'XML/' || replace(s_name, '#', '') || '-' || s_nationkey || '-2017.xml'"


def _files(spark, sf):
    name = F.concat(F.lit("XML/"), F.replace("s_name", F.lit("#"), F.lit("")), F.lit("-"), F.col("s_nationkey"), F.lit("-2017.xml"))
    return table(spark, sf, "supplier").select("s_suppkey", name.alias("path"))


@query("F9_file_name_parts", "SELECT s_suppkey, replace(s_name, '#', '') AS company, replace(s_name, '#', '') || '-' || s_nationkey || '-2017' AS stem FROM supplier")
def _(spark, sf):
    return _files(spark, sf).select("s_suppkey", X.company_of("path").alias("company"), X.file_stem("path").alias("stem"))


@query("K5_output_base_name", "SELECT s_suppkey, replace(s_name, '#', '') || '-' || s_nationkey AS base FROM supplier")
def _(spark, sf):
    return _files(spark, sf).select("s_suppkey", X.base_name("path").alias("base"))


@query("F10_article_text", sql("SELECT \"ArtikelId\", \"Art_Txt_Lang\" || ' ' || \"Art_Txt_Kurz\" || ' ' || coalesce(\"AF_Txt\", '') || ' ' || coalesce(\"AFZ_Txt\", '') AS text FROM main_raw", "main_raw"))
def _(spark, sf):
    return R.main_raw(spark, sf).select("ArtikelId", X.join_texts("Art_Txt_Lang", "Art_Txt_Kurz", "AF_Txt", "AFZ_Txt").alias("text"))


@query("F11_words", "SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS word FROM documents) GROUP BY ALL")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(X.words("text")).alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query("F13_price_difference", 'SELECT p_partkey, p_retailprice AS "Preis", p_size * 30.0::double AS "Preis_Konkurrenz", p_retailprice - p_size * 30.0::double AS "Preisdifferenz" FROM part')
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("Preis"), (F.col("p_size") * 30.0).alias("Preis_Konkurrenz"))
    return price_difference(rows)


@query("F14_shares", "SELECT l_orderkey, l_linenumber, (l_extendedprice - l_extendedprice * (1 - l_discount)) / l_extendedprice AS discount_perc, CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END AS ratio FROM lineitem")
def _(spark, sf):
    gross = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.try_divide(gross - gross * (1 - F.col("l_discount")), gross).alias("discount_perc"),
        F.try_divide("l_discount", "l_tax").alias("ratio"),
    )


@query("F15_log_of_one_plus", "SELECT s_suppkey, CASE WHEN s_acctbal > -1 THEN round(ln(s_acctbal + 1), 6) END AS log FROM supplier")
def _(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", F.round(X.log1p_or_null("s_acctbal"), 6).alias("log"))


@query("F16_calculated_gross_sales", "SELECT l_orderkey, l_linenumber, p_retailprice * l_quantity AS gross FROM lineitem JOIN part ON l_partkey = p_partkey")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select("l_orderkey", "l_linenumber", (F.col("p_retailprice") * F.col("l_quantity")).alias("gross"))


@query("F17_absolute", "SELECT c_custkey, abs(c_acctbal) AS value FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.abs("c_acctbal").alias("value"))


@query("F18_snapshot_label", "SELECT o_orderkey, 'Snapshotdate (' || strftime(o_orderdate, '%Y-%m-%d') || ')' AS label FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.snapshot_label("o_orderdate").alias("label"))


@query("F19_text_to_date", "SELECT o_orderkey, o_orderdate::date AS day FROM orders")
def _(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").select("o_orderkey", F.to_date(text).alias("day"))


@query("F20_twelve_months_back", "SELECT o_orderkey FROM orders WHERE o_orderdate > DATE '2001-08-01' - INTERVAL 12 MONTH")
def _(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderdate") > F.add_months(F.to_date(F.lit(R.AS_OF)), -12)).select("o_orderkey")


_PATH = "(CASE WHEN p_size > 25 THEN [p_type, p_brand, p_name] WHEN p_size > 10 THEN [p_type, p_name] ELSE [p_name] END)"


def _paths(spark, sf):
    path = F.array(F.when(F.col("p_size") > 10, F.col("p_type")), F.when(F.col("p_size") > 25, F.col("p_brand")), F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", X.compact(path).alias("path"))


@query("F21_compact_path", f"SELECT p_partkey, array_to_string({_PATH}, '/') AS path FROM part")
def _(spark, sf):
    return _paths(spark, sf).select("p_partkey", F.array_join("path", "/").alias("path"))


@query("W5_fill_path", f"SELECT p_partkey, {_PATH}[1] AS l1, {_PATH}[least(2, len({_PATH}))] AS l2, {_PATH}[least(3, len({_PATH}))] AS l3, {_PATH}[least(4, len({_PATH}))] AS l4 FROM part")
def _(spark, sf):
    return _paths(spark, sf).select("p_partkey", *(X.path_level("path", i).alias(f"l{i}") for i in range(1, 5)))


@query("F22_yes_or_no", "SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN true WHEN 'SMALL' THEN true ELSE false END AS answer FROM part")
def _(spark, sf):
    answer = F.when(F.col("p_type") == "PROMO", "Ja").when(F.col("p_type") == "SMALL", "yes").when(F.col("p_type") == "LARGE", "nein").when(F.col("p_type") == "MEDIUM", "perhaps")
    return table(spark, sf, "part").select("p_partkey", X.is_yes(answer).alias("answer"))


@query("F24_cluster_label", "SELECT p_partkey, '(1) Low Margin, ' || p_type || ' Sales' AS label FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.cluster_label(F.lit("(1) Low"), "Margin", F.col("p_type"), "Sales").alias("label"))
