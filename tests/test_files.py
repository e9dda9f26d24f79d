import datetime

import pytest
from pyspark.sql import functions as F

from pricelens.functions.nulls import as_number
from pricelens.plans.catalogue import article_rows, articles_from_xml, category_paths, deeper_paths, reference_from_fixed_width, shape_conflicts
from pricelens.plans.track import article_conditions, change_report, price_tracker, read_archive
from pricelens.session import materialise, remove_scratch, scratch_folder, shared_dir
from pricelens.settings import load_settings
from pricelens.sinks.writers import write_analysis, write_archive, write_by_origin, write_semicolon, write_tabs
from pricelens.sources.catalogue_xml import broken_records, read_articles, read_register
from pricelens.sources.database import query_text, run_query_file
from pricelens.sources.delimited import read_semicolon, read_tabs
from pricelens.sources.files import chosen, list_files, name_matches, newest_file, newest_folder, newest_per_folder, newest_snapshot, not_named
from pricelens.sources.fixed_width import LAYOUTS, Layout, read_fixed_width
from pricelens.sources.links import page_links

CATALOGUE = """<?xml version="1.0" encoding="UTF-8"?>
<DataExpert><Body><Katalog>
<Suchbegriffe><Register_Suche>
 <Register_Element_1 Txt="Bad"><Element1_Nr>A2</Element1_Nr>
  <Register_Element_2 Txt="WC"><Register_Element_3 Txt="Sitz"><Element3_Nr>A1</Element3_Nr></Register_Element_3></Register_Element_2>
 </Register_Element_1>
</Register_Suche></Suchbegriffe>
<Artikelmenge>
 <Artikel Art_Nr_Anbieter="A1"><Art_Nr_Hersteller>H1</Art_Nr_Hersteller><Art_Nr_Hersteller_Firma Firma="Laufen">x</Art_Nr_Hersteller_Firma>
  <Art_Txt_Kurz>Sitz</Art_Txt_Kurz><Art_Txt_Kurz>weiss</Art_Txt_Kurz><BM_Einheit><BM_Einheit_Code>STK</BM_Einheit_Code></BM_Einheit>
  <Preis><Preis_Pos>10.5</Preis_Pos><Preis_EAN>76</Preis_EAN></Preis></Artikel>
 <Artikel Art_Nr_Anbieter="A2"><Preis_AF><AF><AF_Nr>001</AF_Nr><AF_Txt>weiss</AF_Txt><Preis_Pos>3</Preis_Pos><EAN>77</EAN></AF>
  <AF><AF_Nr>002</AF_Nr><AF_Txt>schwarz</AF_Txt><Preis_Pos>4</Preis_Pos></AF></Preis_AF></Artikel>
 <Artikel Art_Nr_Anbieter="A3"><Preis><Preis_AF_Zusatz><AFZ><AF_Nr>001</AF_Nr><AF_Txt>chrom</AF_Txt>
  <AFZ_Nr Preis="9" EAN="78" Txt="links">L</AFZ_Nr><AFZ_Nr Preis="8">R</AFZ_Nr></AFZ></Preis_AF_Zusatz></Preis></Artikel>
 <Artikel Art_Nr_Anbieter="A4"><Preis_AF><AF><AF_Nr>1</AF_Nr><Preis_Pos>3</Preis_Pos></AF></Preis_AF>
  <Preis_AF_Zusatz><AFZ><AF_Nr>1</AF_Nr><AFZ_Nr Preis="9">L</AFZ_Nr></AFZ></Preis_AF_Zusatz></Artikel>
 <Artikel Art_Nr_Anbieter="A5"><Preis><Preis_Pos>1</Preis_Pos></Preis><Preis><Preis_Pos>zwei</Preis_Pos></Preis></Artikel>
 <Artikel Art_Nr_Anbieter="A2"><Preis_AF><AF><AF_Nr>002</AF_Nr><AF_Txt>rot</AF_Txt><Preis_Pos>5</Preis_Pos></AF></Preis_AF></Artikel>
</Artikelmenge></Katalog></Body></DataExpert>
"""


def write_catalogue(tmp_path):
    path = tmp_path / "Sabag-12-2017.xml"
    path.write_text(CATALOGUE, encoding="utf-8")
    return str(path)


def test_articles_from_xml(spark, rows, tmp_path):
    table = articles_from_xml(spark, write_catalogue(tmp_path))
    assert rows(table, "ArtikelId", "FarbId", "AusführungsId", "Preis_Pos", "Preis_EAN", "Preis") == [
        ("A1", None, None, 10.5, "76", "10.5"), ("A2", "001", None, 3.0, "77", "3"), ("A2", "002", None, 5.0, None, "5"),
        ("A3", "001", "L", 9.0, "78", "9"), ("A3", "001", "R", 8.0, None, "8"), ("A5", None, None, None, None, "zwei"),
    ]
    first = table.where("ArtikelId = 'A1'").first()
    assert (first.Art_Txt_Kurz, first.Art_Nr_Hersteller_Firma, first.BM_Einheit_Code_BM_Einheit) == ("Sitz weiss", "Laufen", "STK")
    levels = [f"Category_Level_{i}" for i in range(1, 5)]
    assert rows(table.where("ArtikelId IN ('A1', 'A3')").select("ArtikelId", *levels).distinct()) == [("A1", "Bad", "WC", "Sitz", "Sitz"), ("A3", None, None, None, None)]
    assert rows(table.where("ArtikelId = 'A2'").select(*levels).distinct()) == [("Bad",) * 4]


def test_all_register_levels_are_kept(spark, rows, tmp_path):
    opened = "".join(f'<Register_Element_{i} Txt="L{i}">' for i in range(1, 8))
    closed = "".join(f"</Register_Element_{i}>" for i in range(7, 0, -1))
    path = tmp_path / "deep.xml"
    path.write_text(f"<K>{opened}<Element7_Nr>A</Element7_Nr>{closed}<Artikel Art_Nr_Anbieter=\"A\"><Preis><Preis_Pos>1</Preis_Pos></Preis></Artikel></K>", encoding="utf-8")
    levels = [f"Category_Level_{i}" for i in range(1, 11)]
    assert rows(articles_from_xml(spark, str(path)), *levels) == [("L1", "L2", "L3", "L4", "L5", "L6", "L7", "L7", "L7", "L7")]
    paths = category_paths(read_register(spark, str(path)))
    assert rows(deeper_paths(paths, 5), "ArtikelId") == [("A",)] and deeper_paths(paths).count() == 0
    with pytest.raises(Exception, match="more category levels than asked for: A"):
        articles_from_xml(spark, str(path), levels=5).collect()


def test_last_listing_in_the_document_wins(spark, rows, tmp_path):
    path = tmp_path / "branches.xml"
    path.write_text(
        """<K><Register_Element_1 Txt="Z"><Element2_Nr>A</Element2_Nr><Element1_Nr>A</Element1_Nr>
  <Register_Element_2 Txt="Y"><Element1_Nr>A</Element1_Nr><Element1_Nr>B</Element1_Nr></Register_Element_2>
  <Register_Element_2 Txt="X"><Element1_Nr>B</Element1_Nr><Gruppe><Element0_Nr>C</Element0_Nr></Gruppe></Register_Element_2></Register_Element_1>
 <Register_Element_1 Txt="M"><Element0_Nr>C</Element0_Nr></Register_Element_1></K>""",
        encoding="utf-8",
    )
    paths = category_paths(read_register(spark, str(path)))
    # A: the highest kind of its branch; B: the last of equal kinds; C: the later branch, whatever the kind
    assert rows(paths.select("ArtikelId", F.array_join("path", "/"))) == [("A", "Z"), ("B", "Z/X"), ("C", "M")]


def test_elements_count_at_any_depth(spark, rows, tmp_path):
    path = tmp_path / "deep.xml"
    path.write_text(
        """<K><Artikel Art_Nr_Anbieter="P"><Texte><Art_Txt_Kurz>a &amp; b</Art_Txt_Kurz><x><Art_Txt_Kurz>c</Art_Txt_Kurz></x></Texte>
  <Angebot><Preis><Stufe><Preis_Pos>1.5</Preis_Pos></Stufe><Preis_EAN>7</Preis_EAN></Preis></Angebot></Artikel>
 <Artikel Art_Nr_Anbieter="C"><Preis><Liste><Preis_AF><Farben><AF><Nr><AF_Nr>01</AF_Nr></Nr><AF_Txt>rot</AF_Txt><P><Preis_Pos>2</Preis_Pos></P></AF></Farben></Preis_AF></Liste></Preis></Artikel>
 <Artikel Art_Nr_Anbieter="V"><L><Preis_AF_Zusatz><AFZ><A><AF_Nr>02</AF_Nr></A><N><AFZ_Nr Preis="3" Txt="links">L</AFZ_Nr></N></AFZ></Preis_AF_Zusatz></L></Artikel>
 <Artikel Art_Nr_Anbieter="kaputt"><Preis></Artikel>
 <Artikel Art_Nr_Anbieter="leer"/></K>""",
        encoding="utf-8",
    )
    articles = read_articles(spark, str(path))
    assert rows(article_rows(articles), "ArtikelId", "FarbId", "AusführungsId", "Preis_Pos", "Preis_EAN", "Art_Txt_Kurz", "AF_Txt", "AFZ_Txt") == [
        ("C", "01", None, 2.0, None, None, "rot", None), ("P", None, None, 1.5, "7", "a & b c", None, None), ("V", "02", "L", 3.0, None, None, None, "links"),
    ]
    assert broken_records(articles).count() == 1


@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1"])
def test_one_file_is_many_tasks(spark, rows, tmp_path, encoding):
    path = tmp_path / "large.xml"
    records = [f'<Artikel Art_Nr_Anbieter="{i % 900}"><Art_Txt_Kurz>Tür {i}</Art_Txt_Kurz><Preis><Preis_Pos>{i}</Preis_Pos></Preis></Artikel>' for i in range(1000)]
    path.write_bytes(("<K>" + "\n".join(records) + "</K>").encode(encoding))
    expected = sorted((str(i % 900), float(max(i, (i + 900) if i < 100 else i)), f"Tür {max(i, (i + 900) if i < 100 else i)}") for i in range(900))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    try:
        articles = read_articles(spark, str(path), encoding)
        assert articles.select(F.spark_partition_id()).distinct().count() > 4
        assert rows(article_rows(articles), "ArtikelId", "Preis_Pos", "Art_Txt_Kurz") == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_articles_with_both_price_shapes_are_reported(spark, rows, tmp_path):
    articles = read_articles(spark, write_catalogue(tmp_path))
    assert rows(shape_conflicts(articles), "ArtikelId") == [("A4",)]
    assert "A4" not in {r.ArtikelId for r in article_rows(articles).collect()}


def test_fixed_width_dos_file(spark, tmp_path):
    path = tmp_path / "X.DAT"
    path.write_bytes("001Möbel & Türen   X\n001Möbel & Türen   X\n\x1a".encode("cp850"))
    layout = Layout((3, 16, 1), ("id", "text", "code"))
    assert [tuple(r) for r in reference_from_fixed_width(spark, str(path), layout).collect()] == [("001", "Möbel  &  Türen", "X")]
    assert read_fixed_width(spark, str(path), layout).count() == 2  # the reader skips the line without text


def test_layout_widths():
    totals = {name: (len(layout.columns), sum(layout.widths)) for name, layout in LAYOUTS.items()}
    assert totals == {"KOMART0": (16, 93), "KOMPRS": (10, 58), "KOMFAK": (4, 12), "KOMAUP": (11, 65), "KOMWGR": (5, 94)}


def archive_files(tmp_path):
    for day, price in (("2017-11-27", "10"), ("2018-01-15", "12")):
        folder = tmp_path / "Archiv" / day
        folder.mkdir(parents=True)
        for company in ("Sabag", "Saneo", "Fremd"):
            if company == "Saneo" and day == "2018-01-15":
                continue
            header = '"ArtikelId";"FarbId";"AusführungsId";"Art_Txt_Lang";"Preis";"Preis_Pos";"Category_Level_1";"Category_Level_2";"Category_Level_3";"Category_Level_4"\r\n'
            (folder / f"{company}-1.csv").write_text(header + f'"a";"";"";"zwei\r\nZeilen";"{price}";"{price}";"c";"c";"c";"c"\r\n', encoding="utf-8", newline="")
    return str(tmp_path / "Archiv")


def test_tracker_over_the_archive(spark, rows, tmp_path):
    path = archive_files(tmp_path)
    archive = read_archive(spark, path)
    some = read_archive(spark, path, dates=["2018-01-15"], companies=["Sabag"])
    assert [f.rsplit("/", 2)[1:] for f in some.inputFiles()] == [["2018-01-15", "Sabag-1.csv"]]  # only chosen files are in the plan
    assert rows(some, "Company", "Preis") == [("Sabag", "12")]
    with pytest.raises(ValueError):
        read_archive(spark, path, dates=["1990-01-01"])
    tracked = price_tracker(archive, ["Sabag", "Saneo", "Missing"])
    assert rows(tracked, "Company", "Snapshotdate_String", "Preis", "Art_Txt_Lang") == [
        ("Sabag", "Snapshotdate (2017-11-27)", 10.0, "zwei Zeilen"), ("Sabag", "Snapshotdate (2018-01-15)", 12.0, "zwei Zeilen"), ("Saneo", "Snapshotdate (2017-11-27)", 10.0, "zwei Zeilen"),
    ]
    newest = newest_snapshot(archive, by="Company")
    assert rows(newest, "Company", "Snapshotdate") == [("Fremd", datetime.date(2018, 1, 15)), ("Sabag", datetime.date(2018, 1, 15)), ("Saneo", datetime.date(2017, 11, 27))]
    assert newest_snapshot(archive).count() == 2
    sales = spark.createDataFrame([("a000", 7.0)], "SGVSB string, Umsatz double")
    report = change_report(archive, "Sabag", "2017-11-27", "2018-01-15", sales)
    assert rows(report, "UID", "Diff", "`Diff%`", "Umsatz") == [("a000", 2.0, 0.2, 7.0)]


def test_article_conditions(spark, rows):
    articles = [("Ä1", "u1", "x"), ("b ", "u2", "x"), ("c", "  ", "x"), ("d", None, "x"), ("e", "u5", "00008537 "), ("f", "u6", None)]
    master = spark.createDataFrame(articles, "Artikel string, SGVSB string, Lieferant string")
    conditions = spark.createDataFrame([("Ä1", 3.0), ("Ä1", 5.0)], "Artikel string, Bruttoverkauf double")
    sales = spark.createDataFrame([("a1  ", 2.0), ("A1  ", 4.0), ("B", 1.0)], "iditemOrigin string, Sales double")
    joined = article_conditions(master, conditions, sales.withColumn("iditemOrigin", F.lower("iditemOrigin")))
    assert rows(joined, "Artikel", "Bruttoverkauf", "Umsatz") == [("b ", None, 1.0), ("Ä1", 5.0, 6.0)]


def test_delimited_files(spark, rows, tmp_path):
    frame = spark.createDataFrame([("1", 'a;"b"\nc', None), ("2", "NA", "x")], "id string, t string, u string")
    write_semicolon(frame, str(tmp_path / "s"))
    assert rows(read_semicolon(spark, str(tmp_path / "s"), frame.columns)) == rows(frame)
    numbers = spark.createDataFrame(
        [("a", 'x;"y"\nz', 1.0, 3, True, datetime.date(2018, 1, 2)), ("b", None, 12345678.9, None, False, None), ("", "", 0.00012, -7, None, None), ("c", "é", 1.5e-5, 0, None, None), ("d", "e", 1e16, 1, None, None), ("f", "g", None, 2, None, None)],
        'id string, `t"x` string, p double, n long, b boolean, d date',
    )
    write_semicolon(numbers.coalesce(1), str(tmp_path / "q"))
    written = next((tmp_path / "q").glob("part-*")).read_bytes().decode()
    assert written == (
        '"id";"t""x";"p";"n";"b";"d"\n"a";"x;""y""\nz";1.0;3;True;"2018-01-02"\n"b";"";12345678.9;"";False;""\n'
        '"";"";0.00012;-7;"";""\n"c";"é";1.5e-05;0;"";""\n"d";"e";1e+16;1;"";""\n"f";"g";"";2;"";""\n'
    )
    flat = frame.withColumn("t", F.regexp_replace("t", "\n", " "))
    write_tabs(flat, str(tmp_path / "t"))
    assert rows(read_tabs(spark, str(tmp_path / "t"))) == rows(flat)


def test_archive_replaces_only_its_date(spark, tmp_path):
    path = str(tmp_path / "archive")
    for day, n in (("2018-01-01", 3), ("2018-01-02", 5), ("2018-01-01", 4)):
        write_archive(spark.range(n), path, day)
    counts = {str(r.snapshot_date): r["count"] for r in spark.read.parquet(path).groupBy("snapshot_date").count().collect()}
    assert counts == {"2018-01-01": 4, "2018-01-02": 5}


def test_analysis_outputs(spark, tmp_path):
    frame = materialise(spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", None)], "UID string, Sales_LTM double"), "t")
    targets = write_analysis(frame, str(tmp_path), "2018-01-01")
    sizes = {name: read_tabs(spark, path).count() for name, path in targets.items()}
    assert sizes == {
        "2018-01-01_Output_Analysis_full": 3, "Output_Analysis_full": 3, "2018-01-01_Output_Analysis_with_sales": 1, "Output_Analysis_with_sales": 1,
    }


def test_file_listing_and_choice(spark, rows, tmp_path):
    for name in ("Sabag-1.csv", "Saneo-2.csv", "SabagBadmoebel-3.csv", "note.txt"):
        folder = tmp_path / "in" / name[:2]
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("x\n")
    files = list_files(spark, str(tmp_path / "in"), ".csv")
    assert files.count() == 3
    chosen = files.where(name_matches(["sabag", "saneo"], F.col("path")))
    assert sorted(r.path.split("/")[-1] for r in chosen.collect()) == ["Sabag-1.csv", "Saneo-2.csv"]
    assert files.where(not_named("Badmoebel", F.col("path"))).count() == 2


def test_newest_files_are_chosen_before_reading(spark, rows, tmp_path):
    for name in ("XML/Sabag/2017-12.csv", "XML/Sabag/2018-01.csv", "XML/Saneo/2017-[11].csv", "XML/Saneo/2016.csv", "XML/Saneo/z.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"a\n{name}\n")
    for name in ("2018 Lauf 1 ABC/x/KOMPRS.DAT", "2018 Lauf 2 ABC/KOMPRS.DAT", "2018 Lauf 2 ABC/y/KOMART0.DAT", "zuletzt/KOMPRS.DAT"):
        (tmp_path / "Stamm" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "Stamm" / name).write_text("x\n")
    newest = newest_per_folder(list_files(spark, str(tmp_path / "XML"), ".csv"))
    table = spark.read.csv(chosen(newest), header=True)
    assert rows(table) == [("XML/Sabag/2018-01.csv",), ("XML/Saneo/2017-[11].csv",)] and len(table.inputFiles()) == 2
    assert rows(newest_file(list_files(spark, str(tmp_path / "XML"), ".csv")), "name") == [("2018-01.csv",)]
    runs = list_files(spark, str(tmp_path / "Stamm"), ".DAT")
    assert rows(newest_folder(runs, str(tmp_path / "Stamm"), ".*Lauf.*ABC"), "name") == [("KOMART0.DAT",), ("KOMPRS.DAT",)]
    assert newest_folder(runs, str(tmp_path / "Stamm"), "nichts").count() == 0


def test_output_per_origin(spark, tmp_path):
    write_by_origin(spark.createDataFrame([("A-1", 1), ("B-2", 2)], "base_name string, v int"), str(tmp_path / "o"))
    assert sorted(p.name for p in (tmp_path / "o").iterdir() if p.is_dir()) == ["base_name=A-1", "base_name=B-2"]


def test_query_file(spark, rows, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("SELECT id FROM numbers\nWHERE id > :least;\n")
    spark.range(5).createOrReplaceTempView("numbers")
    assert query_text(spark, str(path)).endswith(":least")
    assert rows(run_query_file(spark, str(path), least=2)) == [(3,), (4,)]


def test_settings_file(spark, tmp_path):
    path = tmp_path / "settings.json"
    path.write_text('{"Sanitary": {"Main File": "Größe",\n "Companies": {"A": {"Join Keys": [["EAN", "EAN"]]}}}}', encoding="utf-8")
    settings = load_settings(spark, str(path), outlier_threshold=1.5)
    assert settings.main_file == "Größe" and settings.company_names == ["A"] and settings.outlier_threshold == 1.5


def test_links(spark, rows):
    html = '<div class="col_1"><a title="Download Katalog" href="/a.zip">A</a> <a href="/b.zip" title="Other">B</a><a href="http://x/c">C</a></div>'
    pages = spark.createDataFrame([(1, html)], "id int, html string")
    assert rows(page_links(pages, base="http://h"), "title", "link") == [("Download Katalog", "http://h/a.zip")]
    assert rows(page_links(pages, base="http://h", value=None), "link") == [("http://h/a.zip",), ("http://h/b.zip",), ("http://x/c",)]


def test_materialised_tables_lie_in_the_shared_folder(spark):
    frame = materialise(spark.range(3).withColumn("Preis (CHF)", F.lit("1.5")), "numbers")
    assert shared_dir(spark) in frame.inputFiles()[0]
    assert frame.select(as_number("Preis (CHF)")).first()[0] == 1.5


def test_scratch_is_removed_at_the_end(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pricelens.session.shared_dir", lambda _: str(tmp_path))
    materialise(spark.range(3), "numbers")
    assert [p.name for p in tmp_path.iterdir()] == [scratch_folder(spark).rsplit("/", 1)[1]]
    assert remove_scratch(spark) and not list(tmp_path.iterdir()) and not remove_scratch(spark)
