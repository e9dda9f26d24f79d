"""Checks of joins, aggregates, windows, sorts and set operations."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.operators import cascade as C
from pricelens.operators.basket import basket_rules
from pricelens.operators.joins import aligned_update, fill_missing_join, left_join_present
from pricelens.operators.nearest_text import nearest_text
from pricelens.operators.outliers import difference_spread, flag_outliers
from pricelens.operators.ranking import average_rank, first_name_per_group, keep_best, last_write_wins, price_difference, rank_candidates
from pricelens.operators.reshape import pivot_offers, price_change, unpivot_offers, wide_articles
from pricelens.plans.analyse import consequent_texts, join_group_names
from pricelens.plans.prepare import join_reference, prepare_catalogue
from pricelens.plans.sales import SalesRules, combined_sales, sales_measures, system_a, system_b
from pricelens.plans.track import article_conditions
from pricelens.session import materialise
from workload import roles as R
from workload.registry import query
from workload.roles import sql, table


def prepared(spark, sf):
    """Prepared main catalogue and prepared competitor catalogues."""
    main = prepare_catalogue(join_reference(R.main_raw(spark, sf), R.reference(spark, sf)))
    return main, prepare_catalogue(R.competitor_raw(spark, sf))


def stored(spark, sf):
    """The same, written once, for queries that use a side several times."""
    main, competitors = prepared(spark, sf)
    return materialise(main, "prepared-main"), materialise(competitors, "prepared-competitors")


@query("J1_left_join_present_keys", sql('SELECT m."UID", c."Konkurrenz", c."Preis" AS price FROM main m LEFT JOIN competitor c ON m."EAN" = c."EAN"', "main", "competitor"))
def _(spark, sf):
    main, comp = prepared(spark, sf)
    joined = left_join_present(main.select("UID", "EAN"), comp.select("EAN", "Konkurrenz", "Preis"), "EAN", "EAN")
    return joined.select("UID", F.col("Konkurrenz___y").alias("Konkurrenz"), F.col("Preis___y").alias("price"))


@query("J2_composite_key_null_equals_null", sql('SELECT m."ArtikelId", c."Konkurrenz", c.price FROM main_raw m LEFT JOIN competitor_raw c ON m."ArtikelId" = c."ArtikelId" AND m."FarbId" IS NOT DISTINCT FROM c."FarbId"', "main_raw", "competitor_raw"))
def _(spark, sf):
    right = R.competitor_raw(spark, sf).select("ArtikelId", "FarbId", "Konkurrenz", F.col("Preis_Pos").cast("double").alias("price"))
    joined = left_join_present(R.main_raw(spark, sf).select("ArtikelId", "FarbId"), right, ["ArtikelId", "FarbId"], ["ArtikelId", "FarbId"])
    return joined.select("ArtikelId", F.col("Konkurrenz___y").alias("Konkurrenz"), F.col("price___y").alias("price"))


_FILL = 'SELECT m."UID", coalesce(m."EAN", c."EAN") AS "EAN", CASE WHEN m."EAN" IS NULL AND c."EAN" IS NOT NULL THEN \'k1\' END AS "Joined_on" FROM main m LEFT JOIN competitor c ON m."EAN" IS NULL AND m."Art_Nr_Hersteller" = c."Art_Nr_Hersteller"'


@query("J3_fill_if_missing_join", sql(_FILL, "main", "competitor"))
def _(spark, sf):
    main, comp = prepared(spark, sf)
    filled = fill_missing_join(main.select("UID", "EAN", "Art_Nr_Hersteller"), comp, "Art_Nr_Hersteller", "Art_Nr_Hersteller", "EAN", "EAN", "k1")
    return filled.select("UID", "EAN", "Joined_on")


_CASCADE = 'SELECT m."UID", k."Konkurrenz", c.other AS "Preis_Konkurrenz", c.tag AS "Joined_on", c.kurz AS "Txt_Kurz_Konkurrenz" FROM main m CROSS JOIN (SELECT DISTINCT "Konkurrenz" FROM competitor) k LEFT JOIN cascade c ON m."UID" = c."UID" AND k."Konkurrenz" = c."Konkurrenz"'


def _all_companies(spark, sf, cascade):
    """``cascade(left, right, keys)`` of every competitor with its own keys, one below the other."""
    main, comp = prepared(spark, sf)
    keys = [k for company in R.SETTINGS.companies.values() for k in company]
    left, right = (list(dict.fromkeys(c for k in keys for c in getattr(k, side))) for side in ("left", "right"))
    main = materialise(main.select(*dict.fromkeys(["UID", *left])), "cascade-main")
    comp = materialise(comp.select(*dict.fromkeys(["Konkurrenz", *C.RIGHT_UPDATE, *right])), "cascade-competitors")
    parts = [
        cascade(C.with_empty_offer(main), comp.where(F.col("Konkurrenz") == company), keys).withColumn("Konkurrenz", F.lit(company))
        for company, keys in R.SETTINGS.companies.items()
    ]
    return reduce(DataFrame.unionByName, [p.select("UID", "Konkurrenz", "Preis_Konkurrenz", "Joined_on", "Txt_Kurz_Konkurrenz") for p in parts])


@query("J4_chained_cascade", sql(_CASCADE, "main", "cascade"))
@query("J4_chained_cascade_all", sql(_CASCADE, "main", "cascade"))
def _(spark, sf):
    return _all_companies(spark, sf, C.chained_cascade)


@query("J4_single_join_cascade", sql(_CASCADE, "main", "cascade"))
@query("J4_single_join_cascade_all", sql(_CASCADE, "main", "cascade"))
def _(spark, sf):
    return _all_companies(spark, sf, lambda left, right, keys: C.single_join_cascade(left, right, keys, "UID"))


@query("J4_best_offers", sql('SELECT "UID", "Konkurrenz", tag AS "Joined_on", other AS "Preis_Konkurrenz", rid FROM cascade QUALIFY row_number() OVER (PARTITION BY "UID", "Konkurrenz" ORDER BY abs("Preis" - other), rid) = 1', "cascade"))
def _(spark, sf):
    main, comp = stored(spark, sf)
    return C.best_offers(main, comp, R.SETTINGS.companies, "UID").select("UID", "Konkurrenz", "Joined_on", "Preis_Konkurrenz", "rid")


@query("J5_reference_enrichment", sql('SELECT "ArtikelId", "Konkurrenznummer", "Warengruppe" FROM main', "main"))
def _(spark, sf):
    return join_reference(R.main_raw(spark, sf), R.reference(spark, sf)).select("ArtikelId", "Konkurrenznummer", "Warengruppe")


def _nearest_sql(left, left_id, right, right_id):
    word = "unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'))"
    return f"""WITH lw AS (SELECT {left_id} AS lid, {word} AS w FROM {left}), rw AS (SELECT {right_id} AS rid, {word} AS w FROM {right}),
l AS (SELECT lid, w, count(*) AS n FROM lw GROUP BY ALL), r AS (SELECT rid, w, count(*) AS n FROM rw WHERE w IN (SELECT w FROM lw) GROUP BY ALL),
ln AS (SELECT lid, sum(n * n) AS s FROM l GROUP BY ALL), rn AS (SELECT rid, sum(n * n) AS s FROM r GROUP BY ALL),
p AS (SELECT lid, rid, sum(l.n * r.n) AS d FROM l JOIN r USING (w) GROUP BY ALL),
k AS (SELECT lid, rid, round(1 - d / (sqrt(ln.s) * sqrt(rn.s)), 9) AS distance FROM p JOIN ln USING (lid) JOIN rn USING (rid)),
best AS (SELECT * FROM k WHERE distance < 0.3 QUALIFY row_number() OVER (PARTITION BY lid ORDER BY distance, rid) = 1)"""


_DOC_WORDS = _nearest_sql("documents", "doc_id", "benchmark", "item_id")


@query("J6_nearest_text", _DOC_WORDS + ' SELECT lid AS doc_id, rid AS "Closest", round(distance, 8) AS "Distance" FROM best')
def _(spark, sf):
    near = nearest_text(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id", "item_id")
    return near.select("doc_id", "Closest", F.round("Distance", 8).alias("Distance"))


_EVEN, _ODD = ("(SELECT * FROM documents WHERE doc_id % 2 = {0})".format(i) for i in (0, 1))


@query("J6_documents", _nearest_sql(_EVEN, "doc_id", _ODD, "doc_id") + ' SELECT lid AS doc_id, rid AS "Closest", round(distance, 6) + 0 AS "Distance" FROM best')
def _(spark, sf):
    """All documents, those with even ids as one catalogue and those with odd ids as the other."""
    docs = table(spark, sf, "documents")
    near = nearest_text(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1"), "doc_id", "doc_id")
    return near.select("doc_id", "Closest", F.round("Distance", 6).alias("Distance"))


@query("F12_cosine_distance", _nearest_sql("conversations", "conv_id * 1000 + turn", "documents", "doc_id") + ' SELECT lid AS turn_id, rid AS "Closest", round(distance, 8) AS "Distance" FROM best')
def _(spark, sf):
    turns = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("turn_id"), "text")
    near = nearest_text(turns, table(spark, sf, "documents"), "turn_id", "doc_id")
    return near.select("turn_id", "Closest", F.round("Distance", 8).alias("Distance"))


@query("J7_apply_nearest_text", _DOC_WORDS + " SELECT doc_id, b.text AS partner, CASE WHEN rid IS NOT NULL THEN 'Text_Similarity' END AS \"Joined_on\" FROM documents LEFT JOIN best ON doc_id = lid LEFT JOIN benchmark b ON item_id = rid")
def _(spark, sf):
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    near = nearest_text(docs, bench, "doc_id", "item_id").select("doc_id", "Closest")
    left = docs.select("doc_id", F.lit(None).cast("string").alias("partner")).join(near, "doc_id", "left")
    filled = fill_missing_join(left, bench.select("item_id", "text"), "Closest", "item_id", "partner", "text", "Text_Similarity")
    return filled.select("doc_id", "partner", "Joined_on")


@query("J8_left_join_sales_and_rules", "SELECT p_partkey, s.qty, o.n FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem WHERE l_shipdate > DATE '2000-08-01' GROUP BY ALL) s ON s.l_partkey = p_partkey LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) o ON o.l_partkey = p_partkey")
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    sales = lines.where("l_shipdate > date'2000-08-01'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("qty"))
    returned = lines.where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    return table(spark, sf, "part").select("p_partkey").join(sales, "p_partkey", "left").join(returned, "p_partkey", "left")


@query("J9_consequent_text", "SELECT p.p_partkey::varchar AS \"UID\", q.p_name AS \"Consequents_Art_Txt_Lang\" FROM part p LEFT JOIN part q ON q.p_partkey = p.p_size * 3")
def _(spark, sf):
    part, number = table(spark, sf, "part"), F.col("p_partkey").cast("string")
    rules = part.select(number.alias("UID"), (F.col("p_size") * 3).cast("string").alias("Consequents"))
    articles = part.select(number.alias("UID"), F.col("p_name").alias("Art_Txt_Lang"))
    return consequent_texts(rules, articles).select("UID", "Consequents_Art_Txt_Lang")


@query("J10_group_names", "SELECT DISTINCT p_type AS \"Warengruppe\", p_brand, min(p_name) OVER (PARTITION BY p_type) AS \"Warengruppe_Bezeichnung\" FROM part")
def _(spark, sf):
    part = table(spark, sf, "part")
    groups = part.select(F.col("p_type").alias("Warengruppe"), F.col("p_name").alias("Text deutsch"))
    rows = part.select(F.col("p_type").alias("Warengruppe"), "p_brand")
    return join_group_names(rows, groups).distinct().select("Warengruppe", "p_brand", "Warengruppe_Bezeichnung")


def _offers(spark, sf):
    """Lowest price per article and competitor, as a match result."""
    lines = table(spark, sf, "lineitem").join(R.regions(spark, sf), F.col("l_suppkey") == F.col("s_suppkey"))
    low = lines.groupBy("Konkurrenz", "l_partkey").agg(R.cents(F.min(F.col("l_extendedprice") / F.col("l_quantity"))).alias("Preis_Konkurrenz"))
    return low.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_partkey").alias("UID"), "Konkurrenz", F.col("p_retailprice").alias("Preis"), "Preis_Konkurrenz", F.col("p_name").alias("Art_Txt_Kurz")
    )


_OFFERS = """offers AS (SELECT p_partkey AS "UID", "Konkurrenz", p_retailprice AS "Preis", low AS "Preis_Konkurrenz", p_name AS "Art_Txt_Kurz" FROM
(SELECT replace(r_name, ' ', '_') AS "Konkurrenz", l_partkey, floor(min(l_extendedprice / l_quantity) * 100) / 100 AS low FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL) JOIN part ON l_partkey = p_partkey)"""
_WIDE = ", ".join(f"max(\"Preis_Konkurrenz\") FILTER (\"Konkurrenz\" = '{c}') AS \"Preis_Konkurrenz_{c}\"" for c in R.COMPANIES)


@query("A10_pivot_by_competitor", f'WITH {_OFFERS} SELECT "UID", {_WIDE} FROM offers GROUP BY "UID"')
def _(spark, sf):
    return pivot_offers(_offers(spark, sf), R.COMPANIES, "Preis_Konkurrenz")


@query("J11_pivot_with_attributes", f'WITH {_OFFERS} SELECT "UID", "Preis", "Art_Txt_Kurz", {_WIDE} FROM offers GROUP BY ALL')
def _(spark, sf):
    return wide_articles(_offers(spark, sf), R.COMPANIES, "Preis_Konkurrenz")


@query("U3_unpivot_of_pivot", f'WITH {_OFFERS} SELECT "UID", "Konkurrenz", "Preis_Konkurrenz" FROM offers')
def _(spark, sf):
    wide = pivot_offers(_offers(spark, sf), R.COMPANIES, "Preis_Konkurrenz")
    return unpivot_offers(wide, R.COMPANIES, "Preis_Konkurrenz")


@query("J13_two_column_key_joins", sql('SELECT iditem, "UniqueId", "PricingLong", "OrderNo", "Quantity" FROM sales_lines', "sales_lines"))
def _(spark, sf):
    joined = R.sales_lines(spark, sf).join(R.items_a(spark, sf), ["iditem", "idbusinesssection"]).join(R.pricing(spark, sf), "idpricing")
    return joined.select("iditem", F.col("idItemOld").alias("UniqueId"), "PricingLong", "OrderNo", "Quantity")


@query("J14_collated_join", "SELECT a.p_partkey AS left_key, b.p_partkey AS right_key FROM part a LEFT JOIN part b ON a.p_partkey = b.p_partkey AND b.p_size > 10")
def _(spark, sf):
    """Ids that differ in case, accents and trailing blanks."""
    part, blanks = table(spark, sf, "part"), F.repeat(F.lit(" "), F.col("p_partkey").cast("int") % 3)
    left = part.select(F.col("p_partkey").alias("left_key"), F.concat(F.lit("Ärt-"), "p_partkey", blanks).alias("SGVSB"))
    right = part.where("p_size > 10").select(F.col("p_partkey").alias("right_key"), F.concat(F.lit("aRT-"), "p_partkey").alias("UniqueId"))
    return sales_measures(left, right).select("left_key", "right_key")


@query("J15_aligned_update", "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand ELSE p_type END AS p_type FROM part")
def _(spark, sf):
    part = table(spark, sf, "part")
    new = part.where("p_size > 15").select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("p_type"))
    return aligned_update(part.select("p_partkey", "p_type"), new, "p_partkey", "p_type")


@query("J16_conditions_and_sales", """SELECT 'Ä' || p_partkey AS "Artikel", p_name AS "SGVSB", p_brand AS "Lieferant", top AS "Bruttoverkauf", round(total, 4) AS "Umsatz" FROM part
LEFT JOIN (SELECT l_partkey, max(l_extendedprice) AS top FROM lineitem GROUP BY ALL) ON l_partkey = p_partkey
LEFT JOIN (SELECT l_partkey AS k, sum(l_extendedprice) AS total FROM lineitem WHERE l_shipdate >= DATE '2000-01-01' AND l_shipdate < DATE '2001-01-01' GROUP BY ALL) ON k = p_partkey
WHERE p_size % 7 <> 0 AND p_brand <> 'Brand#13'""")
def _(spark, sf):
    """Some articles have an id of blanks, or the excluded supplier; sales ids have trailing blanks."""
    lines, article = table(spark, sf, "lineitem"), F.concat(F.lit("Ä"), "p_partkey")
    uid = F.when(F.col("p_size") % 7 == 0, "  ").otherwise(F.col("p_name"))
    supplier = F.when(F.col("p_brand") == "Brand#13", "00008537 ").otherwise(F.col("p_brand"))
    master = table(spark, sf, "part").select(article.alias("Artikel"), uid.alias("SGVSB"), supplier.alias("Lieferant"))
    conditions = lines.select(F.concat(F.lit("Ä"), "l_partkey").alias("Artikel"), F.col("l_extendedprice").alias("Bruttoverkauf"))
    sales = lines.where("year(l_shipdate) = 2000").select(F.concat(F.lit("a"), "l_partkey", F.lit(" ")).alias("iditemOrigin"), F.col("l_extendedprice").alias("Sales"))
    return article_conditions(master, conditions, sales).withColumn("Umsatz", F.round("Umsatz", 4))


@query("A5_max_per_article", "SELECT l_partkey, max(l_extendedprice) AS top, max(l_tax) AS tax FROM lineitem GROUP BY ALL")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max("l_extendedprice").alias("top"), F.max("l_tax").alias("tax"))


def _rules():
    return SalesRules(R.AS_OF)


def _systems(spark, sf):
    lines = R.sales_lines(spark, sf)
    a = system_a(lines.where("system = 'O'"), R.items_a(spark, sf), R.pricing(spark, sf), _rules())
    b = system_b(lines.where("system = 'F'"), R.items_b(spark, sf), _rules())
    return a, b


def _rounded(df):
    money = ("GrossSales", "Sales", "Margin", "GrossSales_LTM", "Sales_LTM", "Margin_LTM", "ObjectRate")
    return df.withColumns({c: F.round(c, 4) for c in df.columns if c in money})


_ROUND = 'round("GrossSales", 4) AS "GrossSales", round("Sales", 4) AS "Sales", round("Margin", 4) AS "Margin", "Quantity", round("ObjectRate", 4) AS "ObjectRate", "CountOfOrders", "CountOfCustomers"'
_ROUND_LTM = 'round("GrossSales_LTM", 4) AS "GrossSales_LTM", round("Sales_LTM", 4) AS "Sales_LTM", round("Margin_LTM", 4) AS "Margin_LTM", "Quantity_LTM", round("ObjectRate", 4) AS "ObjectRate", "CountOfOrders", "CountOfCustomers"'


@query("A1_sales_per_article", sql(f'SELECT "UniqueId", {_ROUND} FROM system_a', "system_a"))
def _(spark, sf):
    return _rounded(_systems(spark, sf)[0])


@query("A2_both_systems", sql(f'SELECT "UniqueId", {_ROUND_LTM} FROM combined', "combined"))
def _(spark, sf):
    return _rounded(combined_sales(*_systems(spark, sf)))


@query("A3_having", "SELECT l_suppkey, round(sum(l_extendedprice * (l_discount - 0.05)), 4) AS net FROM lineitem GROUP BY ALL HAVING sum(l_extendedprice * (l_discount - 0.05)) > 0")
def _(spark, sf):
    net = F.sum(F.col("l_extendedprice") * (F.col("l_discount") - 0.05))
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(net.alias("net")).where("net > 0").withColumn("net", F.round("net", 4))


@query("A4_conditional_rate", "SELECT o_custkey, round(avg(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0::double ELSE 0.0::double END), 4) AS rate FROM orders GROUP BY ALL")
def _(spark, sf):
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.avg(F.when(urgent, 1.0).otherwise(0.0)), 4).alias("rate"))


@query("A6_mean_per_group", "SELECT p_brand, round(avg(p_retailprice), 4) AS price, round(avg(p_size), 4) AS size FROM part GROUP BY ALL")
def _(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(F.round(F.avg("p_retailprice"), 4).alias("price"), F.round(F.avg("p_size"), 4).alias("size"))


@query("A7_population_spread", f'WITH {_OFFERS} SELECT "Konkurrenz", round(stddev_pop("Preis" - "Preis_Konkurrenz"), 4) AS sigma FROM offers GROUP BY ALL')
def _(spark, sf):
    return difference_spread(_offers(spark, sf)).withColumn("sigma", F.round("sigma", 4))


@query("A8_distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query("A9_last_write_wins", "SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey")
    last = last_write_wins(lines, ["l_partkey", "l_returnflag"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"])
    return last.drop("l_shipdate", "l_suppkey")


@query("A11_two_snapshot_change", sql("""SELECT "ArtikelId" AS "UID", max("Preis") FILTER ("Snapshotdate" = DATE '1999-01-01') AS "1999-01-01", max("Preis") FILTER ("Snapshotdate" = DATE '2000-01-01') AS "2000-01-01",
max("Preis") FILTER ("Snapshotdate" = DATE '2000-01-01') - max("Preis") FILTER ("Snapshotdate" = DATE '1999-01-01') AS "Diff",
(max("Preis") FILTER ("Snapshotdate" = DATE '2000-01-01') - max("Preis") FILTER ("Snapshotdate" = DATE '1999-01-01')) / max("Preis") FILTER ("Snapshotdate" = DATE '1999-01-01') AS "Diff%"
FROM archive WHERE "Snapshotdate" IN (DATE '1999-01-01', DATE '2000-01-01') GROUP BY ALL""", "archive"))
def _(spark, sf):
    rows = R.archive(spark, sf).select(F.col("ArtikelId").alias("UID"), F.col("Snapshotdate").cast("string").alias("Timestamp"), "Preis_Pos")
    return price_change(rows, "1999-01-01", "2000-01-01")


@query("A12_match_rates", sql("""SELECT "Konkurrenz", tag AS "Joined_on", matched, articles, matched / articles AS share FROM (
SELECT *, ((SELECT count(DISTINCT "UID") FROM main) - coalesce(sum(matched) OVER (PARTITION BY "Konkurrenz" ORDER BY prio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::bigint AS articles
FROM (SELECT "Konkurrenz", prio, tag, count(DISTINCT "UID") AS matched FROM cascade GROUP BY ALL))""", "main", "cascade"))
def _(spark, sf):
    main, comp = stored(spark, sf)
    return C.match_rates(C.best_offers(main, comp, R.SETTINGS.companies, "UID"), main, R.SETTINGS.companies)


@query("A13_first_name_per_group", "SELECT p_brand, min(p_name) AS p_name FROM part GROUP BY ALL")
def _(spark, sf):
    return first_name_per_group(table(spark, sf, "part"), "p_brand", "p_name")


@query("A14_basket_rules", """WITH items AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS i FROM lineitem), n AS (SELECT i, count(*) AS n FROM items GROUP BY ALL),
pairs AS (SELECT a.i AS a, b.i AS b, count(*) AS t FROM items a JOIN items b ON a.o = b.o AND a.i <> b.i GROUP BY ALL)
SELECT a AS "antecedants", b AS "Consequents", t / (SELECT count(DISTINCT o) FROM items) AS "Support", t / n.n AS "Confidence", round(s, 4) AS "SalesConsequents_LTM"
FROM pairs JOIN n ON n.i = a JOIN (SELECT l_partkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY ALL) ON l_partkey = b
QUALIFY row_number() OVER (PARTITION BY a ORDER BY t DESC, b) = 1""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("basket"), F.col("l_partkey").alias("item"), F.col("l_extendedprice").alias("sales"))
    return basket_rules(lines).withColumn("SalesConsequents_LTM", F.round("SalesConsequents_LTM", 4))


def _ranked(spark, sf):
    """All lines of an article as candidates, against the list price."""
    return price_difference(
        table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_partkey").alias("UID"), F.col("l_suppkey").alias("Konkurrenz"), "l_orderkey", "l_linenumber", F.col("p_retailprice").alias("Preis"),
            F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice") / F.col("l_quantity")).alias("Preis_Konkurrenz"),
        )
    )


_CANDIDATES = """candidates AS (SELECT l_partkey AS "UID", l_suppkey AS "Konkurrenz", l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN abs(p_retailprice - l_extendedprice / l_quantity) END AS gap FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query("W1_rank_candidates", f'WITH {_CANDIDATES} SELECT "UID", l_orderkey, l_linenumber, gap, CASE WHEN gap IS NOT NULL THEN (row_number() OVER (PARTITION BY "UID", gap IS NULL ORDER BY gap, l_orderkey, l_linenumber))::int END AS "Rank" FROM candidates')
def _(spark, sf):
    ranked = rank_candidates(_ranked(spark, sf), "UID", ["l_orderkey", "l_linenumber"])
    return ranked.select("UID", "l_orderkey", "l_linenumber", F.col("Preisdifferenz_absolut").alias("gap"), "Rank")


@query("W2_keep_best", f'WITH {_CANDIDATES} SELECT "UID", l_orderkey, l_linenumber, gap FROM candidates WHERE gap IS NOT NULL QUALIFY row_number() OVER (PARTITION BY "UID" ORDER BY gap, l_orderkey, l_linenumber) = 1')
def _(spark, sf):
    best = keep_best(_ranked(spark, sf), "UID", ["l_orderkey", "l_linenumber"])
    return best.select("UID", "l_orderkey", "l_linenumber", F.abs("Preisdifferenz").alias("gap"))


@query("W3_dense_rank", "SELECT DISTINCT p_type, p_name FROM (SELECT p_type, p_name, dense_rank() OVER (PARTITION BY p_type ORDER BY p_name) AS r FROM part) WHERE r = 1")
def _(spark, sf):
    order = Window.partitionBy("p_type").orderBy("p_name")
    return table(spark, sf, "part").select("p_type", "p_name", F.dense_rank().over(order).alias("r")).where("r = 1").drop("r").distinct()


@query("W4_average_rank", "WITH m AS (SELECT p_brand, round(avg(p_size)) AS size FROM part GROUP BY ALL) SELECT p_brand, size, rank() OVER (ORDER BY size) + (count(*) OVER (PARTITION BY size) - 1) / 2.0::double AS rank FROM m")
def _(spark, sf):
    means = table(spark, sf, "part").groupBy("p_brand").agg(F.round(F.avg("p_size")).alias("size"))
    return average_rank(means, "size", "rank")


@query("O1_sorted_candidates", f'WITH {_CANDIDATES} SELECT "UID", l_orderkey, l_linenumber, gap FROM candidates ORDER BY "UID", gap NULLS FIRST, l_orderkey, l_linenumber')
def _(spark, sf):
    return _ranked(spark, sf).select("UID", "l_orderkey", "l_linenumber", F.abs("Preisdifferenz").alias("gap")).orderBy("UID", "gap", "l_orderkey", "l_linenumber")


@query("O2_sort_by_sales", "SELECT l_partkey, round(sum(l_extendedprice), 4) AS \"Umsatz\" FROM lineitem GROUP BY ALL ORDER BY 2 DESC, 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.round(F.sum("l_extendedprice"), 4).alias("Umsatz")).orderBy(F.col("Umsatz").desc(), "l_partkey")


@query("O3_nearest_of_row", f'WITH {_CANDIDATES} SELECT "UID", min(gap) AS gap FROM candidates WHERE gap IS NOT NULL GROUP BY ALL')
def _(spark, sf):
    best = F.min(F.struct(F.abs("Preisdifferenz").alias("gap"), "l_orderkey"))
    return _ranked(spark, sf).where("Preisdifferenz is not null").groupBy("UID").agg(best.alias("b")).select("UID", "b.gap")


@query("O4_first_rows", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 201")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name").orderBy("p_partkey").limit(201)


@query("U1_union_all", "SELECT l_partkey AS item, l_quantity AS quantity FROM lineitem UNION ALL SELECT p_partkey, p_size::double FROM part")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_quantity").alias("quantity"))
    return lines.unionByName(table(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.col("p_size").cast("double").alias("quantity")))


@query("U2_concat_rows", "SELECT p_partkey AS id, p_name AS name, NULL::double AS balance FROM part UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return part.unionByName(customers, allowMissingColumns=True)


@query("M6_outlier_flag", f'WITH {_OFFERS}, s AS (SELECT "Konkurrenz" AS k, stddev_pop("Preis" - "Preis_Konkurrenz") AS sigma FROM offers GROUP BY ALL) SELECT "UID", "Konkurrenz", abs("Preis" - "Preis_Konkurrenz") / "Preis" > 2.5 * sigma / "Preis" AS "Outlier" FROM offers JOIN s ON k = "Konkurrenz"')
def _(spark, sf):
    return flag_outliers(_offers(spark, sf), R.COMPANIES, 2.5).select("UID", "Konkurrenz", "Outlier")


@query("X1_composed_steps", f'WITH {_CANDIDATES} SELECT "UID", gap FROM candidates WHERE gap IS NOT NULL QUALIFY row_number() OVER (PARTITION BY "UID" ORDER BY gap, l_orderkey, l_linenumber) = 1')
def _(spark, sf):
    steps = _ranked(spark, sf).transform(keep_best, by="UID", tie=["l_orderkey", "l_linenumber"])
    return steps.select("UID", F.abs("Preisdifferenz").alias("gap"))


@query("X5_name_or_list", "SELECT l_partkey, l_returnflag, max(l_linenumber) AS n FROM lineitem GROUP BY ALL")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", F.col("l_linenumber").alias("n"))
    return last_write_wins(lines, ["l_partkey", "l_returnflag"], "n")


@query("S8_key_coverage", sql('SELECT "Konkurrenz" AS company, 1 AS prio, count(DISTINCT "EAN") AS keys FROM competitor GROUP BY ALL UNION ALL SELECT "Konkurrenz", 2, count(DISTINCT "Art_Nr_Hersteller_UID") FROM competitor GROUP BY ALL UNION ALL SELECT "Konkurrenz", 3, count(DISTINCT "Art_Nr_Hersteller") FROM competitor GROUP BY ALL', "competitor"))
def _(spark, sf):
    comp = prepared(spark, sf)[1]
    single = [k.right[0] for k in R.BY_UID[1:]]
    listed = comp.select(F.col("Konkurrenz").alias("company"), F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("key")) for n in single))).alias("k"))
    config = R.SETTINGS.to_frame(spark).select("company", "prio", F.explode("right_cols").alias("name"))
    keys = listed.select("company", "k.name", "k.key").groupBy("company", "name").agg(F.count_distinct("key").alias("keys"))
    return keys.join(F.broadcast(config), ["company", "name"]).select("company", "prio", "keys")
