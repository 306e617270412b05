"""Workbooks that the standard library writes, read by the data source."""

import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from sieveline.plans import cli, pipeline
from sieveline.sources import readers, workbook

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
KINDS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
STYLES = f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm;[Red]0"/><numFmt numFmtId="171" formatCode="0 &quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>'


def letters(i):
    return (letters(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)


def write(path, sheets, places=True, shared=True, dimension=None, extra=""):
    """sheets: name to rows of cells; a cell is text, a number, None or ready XML in a tuple."""
    texts = {}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        names = list(sheets)
        book.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{KINDS}">{extra}<sheets>' + "".join(f'<sheet name="{escape(x)}" sheetId="{i + 1}" r:id="r{i}"/>' for i, x in enumerate(names)) + "</sheets></workbook>")
        rels = [f'<Relationship Id="r{i}" Type="{KINDS}/worksheet" Target="worksheets/s{i}.xml"/>' for i in range(len(names))]
        rels += [f'<Relationship Id="t" Type="{KINDS}/sharedStrings" Target="/xl/sharedStrings.xml"/>', f'<Relationship Id="st" Type="{KINDS}/styles" Target="styles.xml"/>']
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(rels) + "</Relationships>")
        book.writestr("xl/styles.xml", STYLES)
        for i, rows in enumerate(sheets.values()):
            out = []
            for r, row in enumerate(rows):
                cells = []
                for c, x in enumerate(row):
                    at = f' r="{letters(c)}{r + 1}"' if places else ""
                    if isinstance(x, tuple):
                        cells.append(x[0].replace("<c", f"<c{at}", 1))
                    elif isinstance(x, str) and shared:
                        cells.append(f'<c{at} t="s"><v>{texts.setdefault(x, len(texts))}</v></c>')
                    elif isinstance(x, str):
                        cells.append(f'<c{at} t="inlineStr"><is><r><t>{escape(x)}</t></r></is></c>')
                    elif x is not None or not places:
                        cells.append(f"<c{at}><v>{x}</v></c>" if x is not None else "<c/>")
                if cells:
                    out.append(f"<row{f' r=\"{r + 1}\"' if places else ''}>{''.join(cells)}</row>")
            told = f'<dimension ref="{dimension}"/>' if dimension else ""
            book.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {MAIN}>{told}<sheetData>{''.join(out)}</sheetData></worksheet>")
        book.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>" + "".join(f'<si><t xml:space="preserve">{escape(x)}</t><rPh><t>aid</t></rPh></si>' for x in texts) + "</sst>")
    return str(path)


def sheet(spark, path, **options):
    workbook.register(spark)
    return spark.read.format("workbook").options(**{k: str(v) for k, v in options.items()}).load(path)


@pytest.mark.parametrize("places", [True, False])
@pytest.mark.parametrize("shared", [True, False])
def test_values(spark, tmp_path, places, shared):
    cells = [("<c t=\"b\"><v>1</v></c>",), ("<c t=\"e\"><v>#N/A</v></c>",), ("<c s=\"1\"><v>44197.5</v></c>",), ("<c s=\"2\"><v>44197</v></c>",), ("<c s=\"3\"><v>7</v></c>",), ("<c t=\"str\"><v>f</v></c>",)]
    rows = [["a", "A", None, "n.m", "e", "f", "g"], [" x & y ", 0.1, 3.0, "é\n<", 1e20, None, None], [], cells, [None, None, None, None, None, None, None, "beyond"]]
    got = sheet(spark, write(tmp_path / "b.xlsx", {"S": rows}, places, shared))
    assert got.columns == ["a", "A.1", "Unnamed: 2", "n.m", "e", "f", "g"]
    assert [tuple(x) for x in got.collect()] == [(" x & y ", "0.1", "3", "é\n<", "1e+20", None, None), ("True", None, "2021-01-01 12:00:00", "2021-01-01 00:00:00", "7", "f", None)]


@pytest.mark.parametrize("dimension", [None, "A1:B40", "A1:B101", "A1:B900", "A1"])
def test_ranges(spark, tmp_path, dimension):
    """Each row is read once, whatever the sheet says of its size; ranges are tasks."""
    path = write(tmp_path / "b.xlsx", {"S": [["k", "v"], *([f"t{i % 7}", i] for i in range(100))]}, dimension=dimension)
    got = sheet(spark, path, rows=9)
    assert sorted((int(x.v), x.k) for x in got.collect()) == [(i, f"t{i % 7}") for i in range(100)]
    if dimension == "A1:B101":
        assert got.rdd.getNumPartitions() == 12
        assert got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] == 9


def test_days_from_1904_and_odd_books(spark, tmp_path):
    path = write(tmp_path / "b.xlsx", {"S": [["d"], [('<c s="1"><v>0</v></c>',)]], "T": [["only names"]], "U": []}, extra='<workbookPr date1904="1"/>')
    assert [tuple(x) for x in sheet(spark, path).collect()] == [("1904-01-01 00:00:00",)]
    assert sheet(spark, path, sheet="T").collect() == [] and sheet(spark, path, sheet="T").columns == ["only names"]
    for lacking in ("U", "V"):
        with pytest.raises(Exception, match="no names|no sheet"):
            sheet(spark, path, sheet=lacking).collect()
    assert [tuple(x) for x in sheet(spark, f"file://{path}").collect()] == [("1904-01-01 00:00:00",)]
    with pytest.raises(ValueError, match=r"\.xlsx"):
        workbook.sheet_names("old.xls")


def test_sheets_of_records(spark, tmp_path):
    """Sheets that are there are put together by names; the third kind has its names one row later; other sheets don't count."""
    names = ["Chemical ID", "SMILES_Structure_Parent", "Test", "Measurement_Value", "Measurement_Unit"]
    books = {"Notes": [["x"]], "PK": [names, ["c2", "CCN", "t", 2, "NA"]], "ADMET": [names[:4], ["c1", "CCO", "t", 1.5]], "데이터": [["a title"], [*names, "Dose"], ["c3", "CCC", "t", 3, "%", "9"]]}
    path = write(tmp_path / "b.xlsx", books)
    got = readers.read_workbook(spark, path)
    assert sorted(map(tuple, got.collect()), key=lambda x: x[0]) == [("c1", "CCO", "t", "1.5", None, None), ("c2", "CCN", "t", "2", None, None), ("c3", "CCC", "t", "3", "%", "9")]
    assert readers.read_records(spark, path).count() == 3
    assert readers.read_workbook(spark, write(tmp_path / "one.xlsx", {"Other": [["k"], ["v"]], "More": [["q"], ["w"]]})).columns == ["k"]


@pytest.mark.parametrize("mode", [[], ["--to-matrix"]])
def test_human_pk(spark, tmp_path, mode):
    rows = [["title"], [], ["Parent SMILES", "AUC"], ["CCO", 3], ["CCN", 4.5]]
    path = write(tmp_path / "trial.xlsx", {"데이터 (Human PK)": rows, "ADMET": [["x"], ["y"]]})
    with pytest.raises(readers.HumanPkWorkbook) as found:
        pipeline.to_wide_matrix(path, spark)
    assert [tuple(x) for x in found.value.frame.orderBy("AUC").collect()] == [("CCO", "3", True), ("CCN", "4.5", True)]
    assert cli.main(["--input-path", path, "--output-path", str(tmp_path / "out"), *mode]) == 0
    back = spark.read.option("header", True).csv(str(tmp_path / "out" / "trial_HumanPK"))
    assert sorted(x.SMILES_Structure_Parent for x in back.collect()) == ["CCN", "CCO"]
