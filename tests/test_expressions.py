import pytest

from pricelens.functions import nulls as N
from pricelens.functions import text as X
from pricelens.operators.reshape import companies_of
from pricelens.settings import JoinKey, default_settings, has_entry, parse_settings


def one(spark, expression, **values):
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expression).first()[0]


@pytest.mark.parametrize(
    "head, colour, variant, expected",
    [("1", "2", "3", "123"), ("1", None, "3", "1"), ("", "2", "3", ""), (None, "2", "3", "")],
)
def test_unique_id(spark, head, colour, variant, expected):
    assert one(spark, X.unique_id("h", "c", "v"), h=head, c=colour, v=variant) == expected


def test_words_keep_umlauts_and_drop_single_letters(spark):
    assert one(spark, X.words("t"), t="Tür a WC-Sitz Größe 12") == ["tür", "wc", "sitz", "größe", "12"]


@pytest.mark.parametrize("number, expected", [("12 34-56/78", "123456"), (None, ""), ("ab", "")])
def test_clean_number(spark, number, expected):
    assert one(spark, X.clean_number("n"), n=number) == expected


def test_clean_text(spark):
    assert one(spark, X.clean_text("t"), t=' a\r\nb "c" \n') == "a b c"


@pytest.mark.parametrize("answer, expected", [("Ja", True), ("TRUE", True), ("n", False), ("maybe", False), (None, False)])
def test_is_yes(spark, answer, expected):
    assert one(spark, X.is_yes("a"), a=answer) is expected


def test_brand_flag_ignores_case_and_blanks(spark):
    assert one(spark, X.mentions("t", "procasa"), t="Lavabo Pro Casa UNO") is True
    assert one(spark, X.mentions("t", "procasa"), t=None) is None


def test_null_if_far(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (9.0, 2.0), (9.0, None), (None, 2.0)], "x double, y double")
    assert [r[0] for r in frame.select(N.null_if_far("x", "y", 4)).collect()] == [1.0, None, 9.0, None]


def test_exceeds_share_with_zero_price(spark):
    frame = spark.createDataFrame([(5.0, 10.0), (6.0, 10.0), (1.0, 0.0), (0.0, 0.0), (None, 10.0)], "d double, p double")
    assert [r[0] for r in frame.select(N.exceeds_share("d", "p", 0.5)).collect()] == [False, True, True, False, False]


def test_null_spellings(spark):
    frame = spark.createDataFrame([("None", "x"), ("", "[None]"), ("a", "\x1a")], "a string, b string")
    assert [tuple(r) for r in N.normalise_nulls(frame).collect()] == [(None, "x"), (None, None), ("a", None)]


def test_missing_all_and_any(spark):
    frame = spark.createDataFrame([("", None), ("x", "")], "a string, b string")
    assert [r[0] for r in frame.select(N.missing(["a", "b"])).collect()] == [True, False]
    assert [r[0] for r in frame.select(N.missing(["a", "b"], "any")).collect()] == [True, True]


def test_lenient_number(spark):
    assert one(spark, N.as_number("t"), t="12.5") == 12.5
    assert one(spark, N.as_number("t"), t="CHF 12") is None


def test_log_of_minus_one_is_null(spark):
    assert one(spark, X.log1p_or_null("x"), x=-1.0) is None
    assert one(spark, X.log1p_or_null("x"), x=0.0) == 0.0


@pytest.mark.parametrize(
    "path, base, company", [("/a/Sabag-12-2017.xml", "Sabag-12", "Sabag"), ("b/Single.csv", "Single", "Single")]
)
def test_file_names(spark, path, base, company):
    assert one(spark, X.base_name("p"), p=path) == base
    assert one(spark, X.company_of("p"), p=path) == company


def test_path_levels_repeat_the_last_entry(spark):
    frame = spark.createDataFrame([(["Bad", None, "WC"],), ([],)], "p array<string>").select(X.compact("p").alias("p"))
    levels = frame.select(*(X.path_level("p", i) for i in range(1, 5))).collect()
    assert [tuple(r) for r in levels] == [("Bad", "WC", "WC", "WC"), (None,) * 4]


def test_snapshot_label(spark):
    frame = spark.sql("SELECT date'2018-01-15' AS d")
    assert frame.select(X.snapshot_label("d")).first()[0] == "Snapshotdate (2018-01-15)"


def test_dos_text(spark):
    assert one(spark, X.repair_dos_text("t"), t="M\u0094bel & T\u0081r") == "Möbel  &  Tür"


def test_default_settings(spark):
    settings = default_settings()
    assert len(settings.output_columns) == 71
    assert settings.companies["Sanitas"][0] == JoinKey.of(("Konkurrenznummer", "Farbe"), ("ArtikelId", "Farbe"))
    assert settings.companies["Sanitas"][0].label == "Konkurrenznummer Farbe"
    table = settings.to_frame(spark)
    assert table.count() == 28
    assert table.where("company = 'Sabag' and prio = 0").first().left_cols == ["UID"]


def test_settings_file_layout():
    document = {"Sanitary": {"Main File": "M", "Companies": {"A": {"Join Keys": [[["x", "y"], ["x", "z"]], ["e", "e"]]}}}}
    settings = parse_settings(document, max_text_distance=0.2)
    assert settings.companies["A"] == (JoinKey.of(("x", "y"), ("x", "z")), JoinKey.of("e"))
    assert settings.max_text_distance == 0.2 and settings.max_price_difference == 0.5
    with pytest.raises(KeyError, match="Companies"):
        parse_settings({"Sanitary": {"Main File": "M"}})
    assert has_entry({"Export": {"CSV": True}}, "Export", "CSV") and not has_entry({}, "Export", "CSV")


def test_companies_of_columns():
    assert companies_of(["Preis", "Preis_Konkurrenz_A", "Preis_Konkurrenz_B", "Preis_Konkurrenz_A_Log"]) == ["A", "B"]
