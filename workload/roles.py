"""The catalogue, competitor, sales and snapshot tables, derived from the generic test tables.

Each role exists twice: as DataFrame and, in ``SQL``, as named sub-query for the SQL check. Regions
are the competitors; a region's catalogue are the articles its suppliers have sold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.session import materialise
from pricelens.settings import JoinKey, Settings, output_columns

COMPANIES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE_EAST")
BY_NUMBER = (
    JoinKey.of(("Konkurrenznummer", "Farbe"), ("ArtikelId", "Farbe")),
    JoinKey.of("EAN"), JoinKey.of("Art_Nr_Hersteller_UID"), JoinKey.of("Art_Nr_Hersteller"),
)
BY_UID = (JoinKey.of("UID"), *BY_NUMBER[1:])
SETTINGS = Settings(
    "part",
    {c: BY_NUMBER if c == "AFRICA" else BY_UID for c in COMPANIES},
    output_columns=output_columns(COMPANIES),
)
AS_OF = "2001-08-01"


SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table. Its schema is looked up in the file once per process."""
    path = f"{sf}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[path]).parquet(path)


def main_raw(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    number = F.col("p_partkey").cast("string")
    ean = F.concat(F.lit("76"), F.lpad(number, 11, "0"))
    variant = F.col("p_type") != "STANDARD"
    return part.select(
        number.alias("ArtikelId"),
        F.when(F.col("p_size") > 10, F.lpad(F.col("p_size").cast("string"), 3, "0")).alias("FarbId"),
        F.when(variant, F.substring("p_type", 1, 1)).alias("AusführungsId"),
        F.col("p_retailprice").cast("string").alias("Preis_Pos"),
        F.when(F.col("p_size") > 25, ean).alias("Preis_EAN"),
        F.when(F.col("p_type") != "PROMO", ean).alias("Art_Nr_EAN"),
        F.concat(F.replace("p_brand", F.lit("Brand#"), F.lit("B")), F.lit("-"), F.col("p_size")).alias("Art_Nr_Hersteller"),
        F.col("p_brand").alias("Art_Nr_Hersteller_Firma"),
        F.col("p_name").alias("Art_Txt_Kurz"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("Art_Txt_Lang"),
        F.split("p_name", " ")[0].alias("AF_Txt"),
        F.when(variant, F.lower("p_type")).alias("AFZ_Txt"),
        F.col("p_type").alias("Category_Level_1"),
        F.col("p_brand").alias("Category_Level_2"),
        F.split("p_name", " ")[1].alias("Category_Level_3"),
        F.col("p_name").alias("Category_Level_4"),
    )


def reference(spark: SparkSession, sf: str) -> DataFrame:
    """Competitor number and product group per article."""
    number = F.col("p_partkey").cast("string")
    return table(spark, sf, "part").select(
        number.alias("Artikelnummer"),
        F.concat(F.lit("Nr. "), F.lpad(number, 6, "0"), F.lit("/a")).alias("Konkurrenznummer"),
        F.substring("p_type", 1, 3).alias("Warengruppe"),
    )


def regions(spark: SparkSession, sf: str) -> DataFrame:
    """Region name per supplier. Three small dimension joins; Spark picks the strategy by size."""
    return (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.replace("r_name", F.lit(" "), F.lit("_")).alias("Konkurrenz"))
    )


def cents(price):
    return F.floor(price * 100) / 100


def competitor_raw(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    prices = (
        lines.join(materialise(regions(spark, sf), "regions"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("Konkurrenz", "l_partkey")
        .agg(cents(F.min(F.col("l_extendedprice") / F.col("l_quantity"))).alias("price"))
    )
    number = F.col("p_partkey").cast("string")
    own = F.when(F.col("p_type").isin("SMALL", "LARGE"), F.concat(F.lit("X"), number)).otherwise(number)
    variant = F.col("p_type") != "STANDARD"
    ean_known = (F.col("p_brand") != "Brand#7") & (F.col("p_size") > 15)
    return prices.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        "Konkurrenz",
        F.when(F.col("Konkurrenz") == "AFRICA", F.lpad(number, 6, "0")).otherwise(own).alias("ArtikelId"),
        F.when(F.col("p_size") > 10, F.lpad(F.col("p_size").cast("string"), 3, "0")).alias("FarbId"),
        F.when(variant, F.substring("p_type", 1, 1)).alias("AusführungsId"),
        F.col("price").cast("string").alias("Preis_Pos"),
        F.lit(None).cast("string").alias("Preis_EAN"),
        F.when(ean_known, F.concat(F.lit("76"), F.lpad(number, 11, "0"))).alias("Art_Nr_EAN"),
        F.concat(F.replace("p_brand", F.lit("Brand#"), F.lit("B")), F.lit("-"), F.col("p_size")).alias("Art_Nr_Hersteller"),
        F.col("p_name").alias("Art_Txt_Kurz"),
        F.concat_ws(" ", "p_name", "p_type", F.replace("p_brand", F.lit("Brand#"), F.lit("Marke "))).alias("Art_Txt_Lang"),
        F.split("p_name", " ")[0].alias("AF_Txt"),
        F.when(variant, F.lower("p_type")).alias("AFZ_Txt"),
    )


def archive(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly snapshots: an article's lowest price at a competitor among the month's sales."""
    lines = table(spark, sf, "lineitem")
    prices = (
        lines.join(regions(spark, sf), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(
            F.col("Konkurrenz").alias("Company"),
            F.trunc("l_shipdate", "month").alias("Snapshotdate"),
            "l_partkey",
        )
        .agg(cents(F.min(F.col("l_extendedprice") / F.col("l_quantity"))).alias("Preis"))
    )
    main = main_raw(spark, sf).drop("Preis_Pos")
    return prices.join(main, F.col("l_partkey").cast("string") == F.col("ArtikelId")).withColumn(
        "Preis_Pos", F.col("Preis").cast("string")
    ).drop("l_partkey")


def sales_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with customer and price kind, in the columns of the sales facts."""
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return lines.select(
        F.col("l_partkey").alias("iditem"),
        F.col("l_returnflag").alias("idbusinesssection"),
        F.col("o_orderpriority").alias("idpricing"),
        F.col("l_shipdate").cast("date").alias("Date"),
        F.col("l_extendedprice").alias("GrossSales"),
        net.alias("Sales"),
        (net - F.col("l_quantity") * 900).alias("Margin"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_orderkey").alias("OrderNo"),
        F.col("o_custkey").alias("idCustomer"),
        F.col("l_linestatus").alias("system"),
    )


def items_a(spark: SparkSession, sf: str) -> DataFrame:
    """Item dimension of the first system: one row per item and business section."""
    sections = F.explode(F.array(*(F.lit(s) for s in ("A", "N", "R"))))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("iditem"),
        sections.alias("idbusinesssection"),
        F.concat(F.lit("Ä"), F.col("p_partkey")).alias("idItemOld"),
        F.when(F.col("p_type") == "PROMO", "09-Andere").otherwise("05-Sanitär").alias("itemgroupgrouphierarchyname_l1"),
    )


def items_b(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("iditem"),
        F.concat(F.lit("0Ä"), F.col("p_partkey")).alias("iditemorigin"),
        F.col("p_brand").alias("Supplier"),
        F.when(F.col("p_type") == "PROMO", "09-Andere").otherwise("05-Sanitär").alias("itemgroupgrouphierarchyname_l1"),
    )


def pricing(spark: SparkSession, sf: str) -> DataFrame:
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Offerte")
        .when(F.col("o_orderpriority") == "2-HIGH", "Baustelle")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Aktionspreise")
        .otherwise("Normal")
    )
    return table(spark, sf, "orders").select(F.col("o_orderpriority").alias("idpricing"), kind.alias("PricingLong")).distinct()


def article_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Article master. Its ids are written in lower case and without accents."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("Artikelnummer"),
        F.col("p_type").alias("Artikelgruppe"),
        F.substring("p_brand", 7, 2).alias("Rabattgruppe"),
        F.col("p_brand").alias("Lieferantenname"),
        F.when(F.col("p_brand") == "Brand#13", "00008537").otherwise(F.col("p_brand")).alias("Lieferant"),
        F.lit("2015-01-01").alias("Erstellt Am"),
        F.col("p_name").alias("Artikelserie"),
        F.concat(F.lit("a"), F.col("p_partkey")).alias("SGVSB"),
        F.col("p_retailprice").alias("Standardkosten"),
        F.when(F.col("p_size") == 50, 1).otherwise(0).alias("Einmalartikel (J/N)"),
    )


_PREPARED = """
  CASE WHEN coalesce("FarbId", '') = '' THEN '000' ELSE "FarbId" END AS "FarbId",
  coalesce("AusführungsId", '') AS "AusführungsId",
  coalesce("AF_Txt", '') AS "Farbe", coalesce("AFZ_Txt", '') AS "Ausführung",
  price AS "Preis", coalesce("Preis_EAN", "Art_Nr_EAN") AS "EAN",
  "ArtikelId" || CASE WHEN coalesce("FarbId", '') = '' THEN '000' ELSE "FarbId" END || coalesce("AusführungsId", '') AS "UID",
  CASE WHEN length("Art_Nr_Hersteller") >= 5 THEN "Art_Nr_Hersteller" END AS "Art_Nr_Hersteller",
  "Art_Nr_Hersteller" || CASE WHEN coalesce("FarbId", '') = '' THEN '000' ELSE "FarbId" END || coalesce("AusführungsId", '') AS "Art_Nr_Hersteller_UID",
  "Art_Txt_Kurz", "Art_Txt_Lang"
"""

SQL = {
    "main_raw": """SELECT p_partkey::varchar AS "ArtikelId",
  CASE WHEN p_size > 10 THEN lpad(p_size::varchar, 3, '0') END AS "FarbId",
  CASE WHEN p_type <> 'STANDARD' THEN substring(p_type, 1, 1) END AS "AusführungsId",
  p_retailprice AS price,
  CASE WHEN p_size > 25 THEN '76' || lpad(p_partkey::varchar, 11, '0') END AS "Preis_EAN",
  CASE WHEN p_type <> 'PROMO' THEN '76' || lpad(p_partkey::varchar, 11, '0') END AS "Art_Nr_EAN",
  replace(p_brand, 'Brand#', 'B') || '-' || p_size AS "Art_Nr_Hersteller",
  p_brand AS "Art_Nr_Hersteller_Firma", p_name AS "Art_Txt_Kurz",
  p_name || ' ' || p_brand || ' ' || p_type AS "Art_Txt_Lang",
  split_part(p_name, ' ', 1) AS "AF_Txt",
  CASE WHEN p_type <> 'STANDARD' THEN lower(p_type) END AS "AFZ_Txt",
  p_type AS "Category_Level_1", p_brand AS "Category_Level_2",
  split_part(p_name, ' ', 2) AS "Category_Level_3", p_name AS "Category_Level_4" FROM part""",
    "main": f"""SELECT "ArtikelId", lpad("ArtikelId", 6, '0') AS "Konkurrenznummer",
  substring("Category_Level_1", 1, 3) AS "Warengruppe", "Art_Nr_Hersteller_Firma",
  "Category_Level_1", "Category_Level_2", "Category_Level_3", "Category_Level_4", {_PREPARED} FROM main_raw""",
    "regions": """SELECT s_suppkey, replace(r_name, ' ', '_') AS "Konkurrenz" FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "competitor_raw": """SELECT "Konkurrenz",
  CASE WHEN "Konkurrenz" = 'AFRICA' THEN lpad(p_partkey::varchar, 6, '0')
       WHEN p_type IN ('SMALL', 'LARGE') THEN 'X' || p_partkey ELSE p_partkey::varchar END AS "ArtikelId",
  CASE WHEN p_size > 10 THEN lpad(p_size::varchar, 3, '0') END AS "FarbId",
  CASE WHEN p_type <> 'STANDARD' THEN substring(p_type, 1, 1) END AS "AusführungsId",
  price, NULL::varchar AS "Preis_EAN",
  CASE WHEN p_brand <> 'Brand#7' AND p_size > 15 THEN '76' || lpad(p_partkey::varchar, 11, '0') END AS "Art_Nr_EAN",
  replace(p_brand, 'Brand#', 'B') || '-' || p_size AS "Art_Nr_Hersteller", p_name AS "Art_Txt_Kurz",
  p_name || ' ' || p_type || ' ' || replace(p_brand, 'Brand#', 'Marke ') AS "Art_Txt_Lang",
  split_part(p_name, ' ', 1) AS "AF_Txt", CASE WHEN p_type <> 'STANDARD' THEN lower(p_type) END AS "AFZ_Txt"
  FROM (SELECT "Konkurrenz", l_partkey, floor(min(l_extendedprice / l_quantity) * 100) / 100 AS price
        FROM lineitem JOIN regions ON l_suppkey = s_suppkey GROUP BY ALL) JOIN part ON l_partkey = p_partkey""",
    "competitor": f"""SELECT "Konkurrenz", "ArtikelId", {_PREPARED} FROM competitor_raw""",
    "archive": """SELECT "Company", "Snapshotdate", "Preis", main_raw.* EXCLUDE (price)
  FROM (SELECT "Konkurrenz" AS "Company", date_trunc('month', l_shipdate)::date AS "Snapshotdate", l_partkey,
          floor(min(l_extendedprice / l_quantity) * 100) / 100 AS "Preis"
        FROM lineitem JOIN regions ON l_suppkey = s_suppkey GROUP BY ALL)
  JOIN main_raw ON l_partkey::varchar = "ArtikelId" """,
    "sales_lines": """SELECT l_partkey AS iditem, l_returnflag AS idbusinesssection, o_orderpriority AS idpricing,
  l_shipdate::date AS "Date", l_extendedprice AS "GrossSales", l_extendedprice * (1 - l_discount) AS "Sales",
  l_extendedprice * (1 - l_discount) - l_quantity * 900 AS "Margin", l_quantity AS "Quantity",
  l_orderkey AS "OrderNo", o_custkey AS "idCustomer", l_linestatus AS system,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Offerte' WHEN '2-HIGH' THEN 'Baustelle' WHEN '3-MEDIUM' THEN 'Aktionspreise' ELSE 'Normal' END AS "PricingLong",
  'Ä' || l_partkey AS "UniqueId", p_brand AS "Supplier",
  CASE WHEN p_type = 'PROMO' THEN '09-Andere' ELSE '05-Sanitär' END AS grp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "recent": """SELECT * FROM sales_lines WHERE grp = '05-Sanitär' AND "Date" > DATE '2000-08-01' AND "Sales" > 0""",
    "system_a": """SELECT "UniqueId", sum("GrossSales") AS "GrossSales", sum("Sales") AS "Sales", sum("Margin") AS "Margin",
  sum("Quantity") AS "Quantity", avg(CASE WHEN "PricingLong" IN ('Offerte', 'Baustelle', 'Aktionspreise') THEN 1.0::double ELSE 0.0::double END) AS "ObjectRate",
  count(DISTINCT "OrderNo") AS "CountOfOrders", count(DISTINCT "idCustomer") AS "CountOfCustomers"
  FROM recent WHERE system = 'O' GROUP BY "UniqueId" """,
    "system_b": """SELECT "UniqueId", sum("GrossSales") AS "GrossSales", sum("Sales") AS "Sales", sum("Margin") AS "Margin",
  sum("Quantity") AS "Quantity", 0.0::double AS "ObjectRate",
  count(DISTINCT "OrderNo") AS "CountOfOrders", count(DISTINCT "idCustomer") AS "CountOfCustomers"
  FROM recent WHERE system = 'F' GROUP BY "UniqueId", "Supplier" """,
    "combined": """SELECT "UniqueId", sum("GrossSales") AS "GrossSales_LTM", sum("Sales") AS "Sales_LTM", sum("Margin") AS "Margin_LTM",
  sum("Quantity") AS "Quantity_LTM", max("ObjectRate") AS "ObjectRate", sum("CountOfOrders")::bigint AS "CountOfOrders",
  sum("CountOfCustomers")::bigint AS "CountOfCustomers"
  FROM (SELECT * FROM system_a UNION ALL SELECT * FROM system_b) GROUP BY "UniqueId" HAVING sum("Sales") > 0""",
    "candidates": """SELECT m."UID", m."Preis", c."Konkurrenz", 0 AS prio, 'Konkurrenznummer Farbe' AS tag, c."UID" AS rid, c."Preis" AS other,
  c."Art_Txt_Kurz" AS kurz, c."Art_Txt_Lang" AS lang FROM main m JOIN competitor c
  ON m."Konkurrenznummer" = c."ArtikelId" AND m."Farbe" IS NOT DISTINCT FROM c."Farbe" AND c."Konkurrenz" = 'AFRICA'
  UNION ALL SELECT m."UID", m."Preis", c."Konkurrenz", 0, 'UID', c."UID", c."Preis", c."Art_Txt_Kurz", c."Art_Txt_Lang"
  FROM main m JOIN competitor c ON m."UID" = c."UID" AND c."Konkurrenz" <> 'AFRICA'
  UNION ALL SELECT m."UID", m."Preis", c."Konkurrenz", 1, 'EAN', c."UID", c."Preis", c."Art_Txt_Kurz", c."Art_Txt_Lang"
  FROM main m JOIN competitor c ON m."EAN" = c."EAN"
  UNION ALL SELECT m."UID", m."Preis", c."Konkurrenz", 2, 'Art_Nr_Hersteller_UID', c."UID", c."Preis", c."Art_Txt_Kurz", c."Art_Txt_Lang"
  FROM main m JOIN competitor c ON m."Art_Nr_Hersteller_UID" = c."Art_Nr_Hersteller_UID"
  UNION ALL SELECT m."UID", m."Preis", c."Konkurrenz", 3, 'Art_Nr_Hersteller', c."UID", c."Preis", c."Art_Txt_Kurz", c."Art_Txt_Lang"
  FROM main m JOIN competitor c ON m."Art_Nr_Hersteller" = c."Art_Nr_Hersteller" """,
    "cascade": """SELECT * FROM candidates QUALIFY prio = min(prio) OVER (PARTITION BY "UID", "Konkurrenz")""",
    "left_words": """SELECT k."Konkurrenz", "UID", unnest(regexp_extract_all(lower(concat_ws(' ', "Art_Txt_Lang", "Art_Txt_Kurz", "Farbe", "Ausführung")), '[\\p{L}\\p{N}_]{2,}')) AS w
  FROM main, (SELECT DISTINCT "Konkurrenz" FROM competitor)
  AS k WHERE NOT EXISTS (SELECT 1 FROM cascade c WHERE c."UID" = main."UID" AND c."Konkurrenz" = k."Konkurrenz")""",
    "right_words": """SELECT "Konkurrenz", "UID", unnest(regexp_extract_all(lower(concat_ws(' ', "Art_Txt_Lang", "Art_Txt_Kurz", "Farbe", "Ausführung")), '[\\p{L}\\p{N}_]{2,}')) AS w FROM competitor""",
    "left_counts": """SELECT "Konkurrenz", "UID", w, count(*) AS n FROM left_words GROUP BY ALL""",
    "right_counts": """SELECT "Konkurrenz", "UID", w, count(*) AS n FROM right_words
  WHERE ("Konkurrenz", w) IN (SELECT ("Konkurrenz", w) FROM left_words) GROUP BY ALL""",
    "text_pairs": """SELECT l."Konkurrenz", l."UID", r."UID" AS rid, sum(l.n * r.n) AS dot
  FROM left_counts l JOIN right_counts r ON l."Konkurrenz" = r."Konkurrenz" AND l.w = r.w GROUP BY ALL""",
    "text_distances": """SELECT p."Konkurrenz", p."UID", rid, round(1 - dot / (sqrt(ln.s) * sqrt(rn.s)), 9) AS "Distance" FROM text_pairs p
  JOIN (SELECT "Konkurrenz", "UID", sum(n * n) AS s FROM left_counts GROUP BY ALL) ln ON ln."Konkurrenz" = p."Konkurrenz" AND ln."UID" = p."UID"
  JOIN (SELECT "Konkurrenz", "UID", sum(n * n) AS s FROM right_counts GROUP BY ALL) rn ON rn."Konkurrenz" = p."Konkurrenz" AND rn."UID" = rid""",
    "nearest": """SELECT * FROM text_distances WHERE "Distance" < 0.3
  QUALIFY row_number() OVER (PARTITION BY "Konkurrenz", "UID" ORDER BY "Distance", rid) = 1""",
    "offers": """SELECT "UID", "Konkurrenz", "Preis", rid, other, kurz, lang, tag, NULL::varchar AS "Closest", NULL::double AS "Distance" FROM cascade
  UNION ALL SELECT m."UID", n."Konkurrenz", m."Preis", rid, c."Preis", c."Art_Txt_Kurz", c."Art_Txt_Lang", 'Text_Similarity', rid, "Distance"
  FROM nearest n JOIN main m ON m."UID" = n."UID" JOIN competitor c ON c."UID" = n.rid AND c."Konkurrenz" = n."Konkurrenz" """,
    "best": """SELECT * FROM offers QUALIFY row_number() OVER (PARTITION BY "Konkurrenz", "UID" ORDER BY abs("Preis" - other), rid) = 1""",
    "matched": """SELECT m."ArtikelId", m."FarbId", m."AusführungsId", m."UID", m."Art_Txt_Kurz", m."Art_Txt_Lang", m."Ausführung", m."Farbe", m."EAN",
  b."Konkurrenz", m."Konkurrenznummer", m."Warengruppe", m."Preis",
  CASE WHEN abs((m."Preis" - other) / m."Preis") > 0.5 THEN NULL ELSE other END AS "Preis_Konkurrenz",
  kurz AS "Txt_Kurz_Konkurrenz", lang AS "Txt_Lang_Konkurrenz", tag AS "Joined_on", m."Preis" - other AS "Preisdifferenz",
  m."Art_Nr_Hersteller_Firma", m."Category_Level_1", m."Category_Level_2", m."Category_Level_3", m."Category_Level_4",
  b."Closest", b."Distance" FROM best b JOIN main m ON m."UID" = b."UID" """,
}

# What a role is built from.
_PARENTS = {
    "main": ["main_raw"], "competitor_raw": ["regions"], "competitor": ["competitor_raw"],
    "archive": ["regions", "main_raw"], "recent": ["sales_lines"], "system_a": ["recent"],
    "system_b": ["recent"], "combined": ["system_a", "system_b"], "candidates": ["main", "competitor"],
    "cascade": ["candidates"], "left_words": ["cascade"], "right_words": ["competitor"],
    "left_counts": ["left_words"], "right_counts": ["right_words", "left_words"],
    "text_pairs": ["left_counts", "right_counts"], "text_distances": ["text_pairs"],
    "nearest": ["text_distances"], "offers": ["cascade", "nearest"], "best": ["offers"], "matched": ["best"],
}


def sql(query: str, *roles: str) -> str:
    """A query with the sub-queries it needs, parents first."""
    ordered: dict[str, str] = {}

    def add(role: str) -> None:
        for parent in _PARENTS.get(role, []):
            add(parent)
        ordered.setdefault(role, SQL[role])

    for role in roles:
        add(role)
    if not ordered:
        return query
    return "WITH " + ",\n".join(f"{r} AS ({body})" for r, body in ordered.items()) + "\n" + query
