import pytest
from pyspark.sql import functions as F

from skyledger.operators import graph
from skyledger.operators.graph import connected_components
from skyledger.operators.grid import label_components
from skyledger.sources import readers as S
from skyledger.sources import sinks as K


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_quotes_breaks_and_extra_columns(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'ID ,NAME,MORE\n1,"a ""b""\nc",x\n2,d,\n')
    df = S.scan_csv(spark, path, ["ID", "NAME"])
    assert [tuple(r) for r in df.orderBy("ID").collect()] == [("1", 'a "b"\nc', "x"), ("2", "d", None)]


@pytest.mark.parametrize("text", ["ID,ID\n1,2\n", "ID,\n1,2\n", "OTHER\n1\n"])
def test_bad_headers_are_rejected(spark, tmp_path, text):
    with pytest.raises(ValueError):
        S.scan_csv(spark, put(tmp_path, "a.csv", text), ["ID"])


def test_obstacles_in_windows_1252(spark, tmp_path):
    path = put(tmp_path, "o.csv", "OAS,CITY\n01-000001,“A”\n\n01-000002,é\n", "windows-1252")
    assert [r["CITY"] for r in S.scan_obstacles(spark, path, ["OAS"]).orderBy("OAS").collect()] == ["“A”", "é"]


def test_fixed_width_keeps_a_ledger(spark, tmp_path):
    path = put(tmp_path, "f.txt", "AB" + "1".rjust(130) + "\nshort\n")
    good, bad = S.scan_fixed_width(spark, path, {"code": (0, 2), "n": (2, 132)})
    assert good.collect()[0].asDict() == {"code": "AB", "n": "1"} and bad.collect()[0]["reason"] == "width"


def test_catalog_xml(spark, tmp_path):
    path = put(tmp_path, "c.xml", '<digital_tpp><state_code ID="AK"><city_name ID="X" volume="V1"><airport_name ID="P" apt_ident="PP"><record><chart_name>ILS</chart_name></record><record><chart_name>VOR</chart_name></record></airport_name></city_name></state_code></digital_tpp>')
    assert [(r["state"], r["ident"], r["chart_name"]) for r in S.scan_catalog_xml(spark, path).orderBy("chart_name").collect()] == [("AK", "PP", "ILS"), ("AK", "PP", "VOR")]


def test_unknown_fields_of_a_record_are_kept(spark, tmp_path):
    path = put(tmp_path, "c.xml", '<d><state_code ID="AK"><city_name ID="X"><airport_name ID="P" military="N"><record><chart_name>ILS</chart_name><odd a="1"> v </odd><empty/></record><record><procuid>7</procuid></record></airport_name></city_name></state_code></d>')
    rows = {r["chart_name"]: r for r in S.scan_catalog_xml(spark, path).collect()}
    assert rows["ILS"]["extra"] == {"odd": "v", "empty": ""} and rows[None]["extra"] == {} and rows[None]["procuid"] == "7" and rows["ILS"]["military"] == "N"


def test_supplement_xml(spark, tmp_path):
    path = put(tmp_path, "s.xml", "<airports><location state='A'><airport><aptid>X</aptid><pdf>NE_12_23JAN2020.pdf</pdf></airport><airport><aptid> </aptid><pdf>NE_1_23JAN2020.pdf</pdf></airport></location></airports>")
    row = S.scan_supplement_xml(spark, path).collect()
    assert [(r["aptid"], r["volume"], r["page"], str(r["edition"])) for r in row] == [("X", "NE", 12, "2020-01-23")]


def test_regulation_xml(spark, tmp_path):
    path = put(tmp_path, "r.xml", '<E><DIV5 N="91" VOLUME="2"><DIV6 N="A"><DIV8 N="91.1"><HEAD>h</HEAD><P>one <I>two</I></P><P>three</P></DIV8></DIV6></DIV5><DIV5 N="92"><DIV8 N="92.1"><P>x</P></DIV8></DIV5></E>')
    rows = S.scan_regulation_xml(spark, path).orderBy("part", "ord").collect()
    assert [(r["part"], r["section"], r["ord"]) for r in rows] == [("91", "91.1", 0), ("91", "91.1", 1), ("92", "92.1", 0)]


def test_publish_commits_by_the_manifest_alone(spark, tmp_path):
    root, first = f"file://{tmp_path}", spark.range(5).withColumn("v", F.col("id") * 2)
    name = K.publish(first, root, "t")
    assert K.current(spark, root, "t").count() == 5
    assert K.publish(first.repartition(3), root, "t") == name
    spark.range(9).write.parquet(f"{root}/t/gen=unfinished")  # a run that stopped before its rename
    assert K.current(spark, root, "t").count() == 5
    K.publish(spark.range(7).withColumn("v", F.col("id")), root, "t")
    assert K.current(spark, root, "t").count() == 7


def test_prune_needs_the_keep_set(spark):
    with pytest.raises(ValueError):
        K.prunable(spark.range(3), spark.range(5), "id")


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7000, 7000)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(50)} | {7000: 7000}


def test_cell_components_corner_contact_and_snake(spark):
    snake = [(x, y) for y in range(0, 12, 2) for x in range(12)] + [(11 if y % 4 == 1 else 0, y) for y in range(1, 11, 2)]
    cells = spark.createDataFrame([*snake, (40, 40), (41, 41)], "x int, y int")
    assert label_components(cells, 64).select("label").distinct().count() == 3
    assert label_components(cells, 64, diagonal=True).select("label").distinct().count() == 2


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rows, made = graph.written, []
    monkeypatch.setattr(graph, "written", lambda df, name: made.append(name) or rows(df, name))
    links = [(i, i + 1) for i in range(300)] + [(0, 0), (300, 0), (150, 900), (900, 901), (901, 150), (901, 950), (7, None), (2000, 3)]
    found = graph.reachable(spark.createDataFrame(links, "src int, dst int"), spark.createDataFrame([(0,), (5000,)], "node int"))
    assert sorted(r[0] for r in found.collect()) == [*range(301), 900, 901, 950, 5000]
    assert made.count("front") < 40
