"""Sources and sinks on files that the tests write."""

import io
import zipfile

from pyspark.sql import functions as F

from metaloom.sources import cells, markup, sinks, tree, xlsx


def test_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'x,y\n1,"two\nlines"\n,\n')
    (tmp_path / "b.csv").write_bytes("n\té\n".encode("latin-1"))
    got = cells.read_delimited(spark, str(tmp_path)).collect()
    a = {(r.row, r.col): r.value for r in got if r.file.endswith("a.csv") and r.error is None}
    assert a == {(0, 0): "x", (0, 1): "y", (1, 0): "1", (1, 1): "two\nlines"}
    assert {r.error for r in got if r.error} == {"1 empty rows", "not UTF-8 at byte 2", "wrong delimiter"}
    assert {r.value for r in got if r.file.endswith("b.csv") and r.error is None} == {"n", "é"}
    sheet = cells.read_delimited(spark, str(tmp_path / "a.csv")).filter("error IS NULL")
    edits = sheet.filter("row = 1 AND col = 0").select("file", "row", "col", F.lit("new").alias("new"))
    assert "new" in {r.value for r in cells.edit_cells(sheet, edits).collect()}


def test_long_and_broken_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1," + "z" * 200_000 + "\n")
    (tmp_path / "b.csv").write_text('x,y\n1,2\n\r"3,\x00\n')
    got = cells.read_delimited(spark, str(tmp_path)).collect()
    assert {len(r.value) for r in got if r.file.endswith("a.csv") and r.row == 1 and r.col == 1} == {200_000}
    assert {r.value for r in got if r.file.endswith("b.csv") and r.row == 1} >= {"1", "2"}


def test_xlsx(spark, tmp_path):
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>name</t></si><si><r><t>a</t></r><r><t>b</t></r></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}" xmlns:r="{rel}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="AB1" t="s"><v>1</v></c></row><row r="2"><c r="A2" s="1"><v>45292</v></c><c r="B2" t="b"><v>1</v></c><c r="C2" t="inlineStr"><is><t>label</t></is></c></row></sheetData><hyperlinks><hyperlink ref="C2" r:id="x"/></hyperlinks></worksheet>')
        z.writestr("xl/worksheets/_rels/sheet1.xml.rels", '<Relationships><Relationship Id="x" Target="https://example.org/"/></Relationships>')
    (tmp_path / "a.xlsx").write_bytes(out.getvalue())
    (tmp_path / "b.xlsx").write_bytes(b"nothing")
    got = xlsx.read_xlsx(spark, str(tmp_path)).collect()
    assert {(r.row, r.col): r.value for r in got if r.error is None} == {(0, 0): "name", (0, 27): "ab", (1, 0): "2024-01-01", (1, 1): "true", (1, 2): "https://example.org/"}
    assert sum(r.error is not None for r in got) == 1


def test_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<mbf appname="x"><data><subject subjectid="s1" species="rat"/><atlas organ="heart"/></data><images><image><filename>i.tif</filename></image></images><contour name="b"/><contour name="a"/><contour name="b"/></mbf>')
    (tmp_path / "b.xml").write_text("no markup")
    (tmp_path / "c.xml").write_text("<other/>")
    (tmp_path / "d.xml").write_text("<a><b></a>")
    got = {r.file[-5:]: r for r in markup.read_xml(spark, str(tmp_path)).collect()}
    assert got["a.xml"].meta.subject.id == "s1" and got["a.xml"].meta.subject.sex is None and got["a.xml"].meta.contours == ["a", "b"] and got["a.xml"].meta.images == ["i.tif"]
    assert got["b.xml"].error.startswith("not XML") and got["c.xml"].dialect == "generic" and got["d.xml"].error.startswith("not XML") and got["d.xml"].dialect is None


def test_ntriples_round_trip(spark, tmp_path):
    rows = [("http://x/a", "http://x/p", 'line\n"quoted" \\ tab\t', "string"), ("_:b", "http://x/p", "http://x/o", "iri"), ("http://x/a", "http://x/p", "_:b", "blank")]
    df = spark.createDataFrame(rows, "s string, p string, o string, o_kind string")
    sinks.ntriples(df).write.text(str(tmp_path / "t"))
    got = markup.read_ntriples(spark, str(tmp_path / "t")).select("s", "p", "o").collect()
    assert sorted(map(tuple, got)) == sorted(r[:3] for r in rows)


def test_tree(spark, tmp_path):
    for name in ("Subjects.csv", "samples.csv", "samples.tsv", "primary/manifest.csv", "primary/subjects.csv", "~$subjects.csv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    files = tree.listing(spark, str(tmp_path), r"/\.")
    got = {r.section: r for r in tree.metadata_files(files, str(tmp_path)).collect()}
    assert set(got) == {"subjects", "samples", "manifest"} and got["subjects"].errors == ["capital letter"] and got["samples"].errors == ["several files"]
    assert {r.suffix: r.n for r in tree.counts(files).collect()} == {".csv": 5, ".tsv": 1}


def test_key_values(spark, tmp_path):
    kv = tree.KeyValues(spark, str(tmp_path / "kv"), "id string, value string")
    kv.put(spark.createDataFrame([("a", "1"), ("b", "2")], kv.schema))
    kv.put(spark.createDataFrame([("b", "3")], kv.schema))
    kv.delete(spark.createDataFrame([("a",)], "id string"))
    assert [tuple(r) for r in kv.read().collect()] == [("b", "3")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], "x\ty\n")], "z int, l array<string>, a string")
    assert sinks.json_rows(df).first().value == '{"a":"x\\ty\\n","l":["a","b"],"z":1}'
    assert sinks.json_ld(df, {"a": "http://x/a"}, "z", "T").first().value.startswith('{"@context":{"a": "http://x/a"},"@id":1,"@type":"T"')
    sinks.write_tsv(df.coalesce(1), str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["z\tl\ta", "1\ta,b\tx y "]
    sinks.write_xml(df.drop("l"), str(tmp_path / "x"))
    assert spark.read.format("xml").option("rowTag", "record").load(str(tmp_path / "x")).count() == 1
    sinks.publish(df, str(tmp_path / "p"), "v1")
    sinks.publish(df.union(df), str(tmp_path / "p"), "v2")
    assert sinks.latest(spark, str(tmp_path / "p")).count() == 2
