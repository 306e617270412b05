import json
import threading
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from sieveline import session
from sieveline.functions import endpoints
from sieveline.functions.cleaning import SENTINEL
from sieveline.operators import chem, dedup, quality, split, stats
from sieveline.plans import cli, pipeline, registry
from sieveline.sources import config, readers, sinks
from sieveline.streaming import records

HEADER = "Chemical ID,SMILES_Structure_Parent,Test*,Test_Type,Measurment_Type,Measurement_Value,Measurement_Unit,Unnamed: 9"


@pytest.fixture(scope="module")
def assay(tmp_path_factory):
    """60 values of one task, some of another, copies, censored and unmapped rows."""
    lines = [HEADER] + [f"C{i},SM{i},Physicochem,ClogP,,{1 + i / 10},,x" for i in range(60)]
    lines += ["C0,SM0,Solubility,Solubility_pH7.4,,5,ug/mL,", "C1,SM1,Solubility,Solubility_pH7.4,,>5,ug/mL,", "C2,SM2,Toxicity,Nothing_known,,3,uM,", "C3,SM3,Toxicity,Ames,,1,Positive,", "C4,SM4,Solubility,Solubility_pH7.4,,NA,ug/mL,", "C5,SM5,In_vivo_PK,PK_iv,MRT,2,hr,"]
    path = tmp_path_factory.mktemp("in") / "assay.csv"
    path.write_text("\r\n".join(lines))
    return str(path)


def test_reading(spark, assay):
    df = readers.read_records(spark, assay)
    assert {"Test", "Measurement_Type", "Measurement_Sex", "row_id"} <= set(df.columns) and not any(x.startswith("Unnamed") for x in df.columns)
    assert df.count() == 66 and df.filter(F.col("Measurement_Type") == SENTINEL).count() == 65
    with pytest.raises(ValueError):
        readers.check_path("x.txt")
    with pytest.raises(FileNotFoundError):
        readers.check_path("/nowhere/x.csv")
    with pytest.raises(ValueError):
        readers.check_path("/etc/x.csv", "/tmp")


def test_sheets(spark):
    assert readers.choose_sheets(["데이터 Human PK", "x"]) == ([("데이터 Human PK", 2)], True)
    assert readers.choose_sheets(["PK", "ADMET"]) == ([("ADMET", 0), ("PK", 0)], False)
    assert readers.choose_sheets(["Sheet1"]) == ([("Sheet1", 0)], False)
    union = readers.union_sheets({"a": spark.createDataFrame([(1,)], "x int"), "b": spark.createDataFrame([(2, 3)], "x int, y int")})
    assert sorted((x.x, x.y) for x in union.collect()) == [(1, None), (2, 3)]


def test_small_sources(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"a": "A"}))
    (tmp_path / "s.csv").write_text("source,target\na,A\nb,B\n")
    (tmp_path / "e.txt").write_text("A\tB\r\n")
    (tmp_path / "f.tsv").write_text("CC\t2\t7\n")
    assert readers.read_synonyms(spark, str(tmp_path / "s.json")) == {"a": "A"}
    assert readers.read_synonyms(spark, str(tmp_path / "s.csv")) == {"a": "A", "b": "B"}
    assert readers.read_endpoints(spark, str(tmp_path / "e.txt")) == ("A", "B")
    assert readers.read_fragments(spark, str(tmp_path / "f.tsv")).first().freq == 7


def test_tasks(spark, assay, tmp_path):
    settings = config.Settings().merged({"input_path": assay, "split": True})
    out = pipeline.run_tasks(spark, settings)
    assert out.count() == 60 and out.select("task").distinct().collect()[0].task == "Physicochem_ClogP"
    stats = out.agg(F.avg("Measurement_Value_scaled"), F.stddev_pop("Measurement_Value_scaled")).first()
    assert abs(stats[0]) < 1e-9 and abs(stats[1] - 1) < 1e-9
    sinks.write_tasks(out, str(tmp_path / "out"), by_split=True)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {x.split: x.n for x in back.groupBy("split").agg(F.count("*").alias("n")).collect()} == {"test": 12, "valid": 6, "train": 42}


def test_tasks_without_toolkit(spark, assay):
    """No raw string under the name of a standard one, and no correction without its inputs."""
    assert not {"Standardized_SMILES", "Scaffold"} & set(pipeline.run_tasks(spark, config.Settings().merged({"input_path": assay})).columns)
    with pytest.raises(chem.ChemBackendUnavailable):
        pipeline.run_tasks(spark, config.Settings().merged({"input_path": assay, "correct_ph": True, "ph_method": "mp"}))


def test_scaffold_split_and_pka_rule_end_to_end(spark, tmp_path):
    """Structures of three ring systems and two chains, in ways of writing of their own, split by whole groups; aspirin and ethanol corrected."""
    rings = ["c1ccccc1", "C1CCCCC1", "c1ccncc1"]
    texts = [("C" * (i % 6 + 1)) + rings[i % 3] for i in range(54)] + ["CC(=O)Oc1ccccc1C(=O)O", "CCO", "CCN", "OCC", "not read", "CC(=O)Oc1ccccc1C(=O)[O-]"]
    path = tmp_path / "in.csv"
    path.write_text("\n".join(["SMILES_Structure_Parent,Test,Measurement_Value,pH"] + [f"{x},Physicochem,{100 + i},4" for i, x in enumerate(texts)]))
    out = pipeline.run_tasks(spark, config.Settings().merged({"input_path": str(path), "split": True, "split_method": "scaffold", "correct_ph": True, "ph_method": "hh", "keep_duplicates": True}))
    rows = out.collect()
    assert len(rows) == 60
    parts = {}
    for x in rows:
        parts.setdefault(x.Ring_Linker_Key, set()).add(x["split"])
    assert all(len(x) == 1 for x in parts.values()) and len(parts) == 5  # three ring systems, no rings, unreadable
    corrected = {x.SMILES_Structure_Parent: (float(x.Measurement_Value), x.Measurement_Value_pH_corrected_hh) for x in rows}
    for text, acid in (("CC(=O)Oc1ccccc1C(=O)O", True), ("CCO", True), ("not read", False)):
        raw, found = corrected[text]
        factor = 0.0016549491248390955 if acid else 1.0
        assert abs(found / raw - factor) < 1e-12


def test_no_quorum(spark, assay, tmp_path):
    few = tmp_path / "few.csv"
    few.write_text(HEADER + "\nC0,SM0,Solubility,S,,5,ug/mL,\n")
    with pytest.raises(quality.TrainingQuorumError):
        pipeline.run_tasks(spark, config.Settings().merged({"input_path": str(few)}))


def test_matrix(spark, assay, tmp_path):
    wide, unmapped = pipeline.run_matrix(spark, config.Settings().merged({"input_path": assay}))
    rows = {x.smiles: x for x in wide.collect()}
    assert len(wide.columns) == 87 and rows["SM0"]["Lipophilicity"] == 1.0 and rows["SM0"]["Solubility"] == 0.005
    assert rows["SM1"]["Solubility"] == 0.005 and rows["SM3"]["AMES"] == 1.0 and rows["SM2"]["DILI"] == 0.0
    assert [x.endpoint_key for x in unmapped.collect()] == ["Toxicity | Nothing_known"]
    told = sinks.write_matrix(wide, str(tmp_path / "m"), "Measurement_Value", "manual", 1, True)
    assert told["rows"] == wide.count() and told["columns"] == 87
    assert sinks.write_unmapped(unmapped, str(tmp_path / "u"), "endpoint_key") == [("Toxicity | Nothing_known", 1)]
    api = pipeline.to_wide_matrix(spark.read.option("header", True).csv(assay))
    assert api.filter("smiles = 'SM2'").first()["DILI"] is None


def test_matrix_reads_its_source_once_for_its_facts(spark, assay, tmp_path):
    """Facts come from the distinct names; these are deleted, and what the matrix still reads is not."""
    settings = config.Settings().merged({"input_path": assay})
    with session.Scratch(spark) as held:
        wide, _, facts = pipeline.matrix_and_facts(spark, settings)
        left = sorted(path.rpartition("/")[2].rpartition("-")[0] for path, _ in held.paths.values())
        assert facts == (5, True) and left == ["endpoint-names", "endpoint-rest"] and wide.count() > 0
    raw = readers.read_csv(spark, assay)
    asked = pipeline.wide_matrix(raw, settings, ask=lambda names: {x: "DILI" for x in names})[0]
    assert asked.filter("DILI IS NOT NULL").count() == asked.count() > 0


def test_matrix_by_command_line(spark, assay, tmp_path):
    assert cli.main(["--input-path", assay, "--to-matrix", "--output-path", str(tmp_path / "out")]) == 0
    told = json.loads(spark.read.text(str(tmp_path / "out" / "metadata")).first()[0])
    assert told["endpoint_map_size"] == 5 and told["has_pk"] is True and told["columns"] == 87


@pytest.mark.parametrize("mode", [[], ["--to-matrix"]])
def test_human_pk_by_command_line(spark, tmp_path, monkeypatch, mode):
    """Such a workbook is written as it is, by both ways in; the reader of its format is replaced here."""
    book = tmp_path / "trial.xlsx"
    book.write_text("")
    frame = spark.createDataFrame([("CCO", "3")], "SMILES_Structure_Parent string, auc string")

    def read(*_):
        raise readers.HumanPkWorkbook(frame)

    monkeypatch.setattr(readers, "read_workbook", read)
    assert cli.main(["--input-path", str(book), "--output-path", str(tmp_path / "out"), *mode]) == 0
    back = spark.read.option("header", True).csv(str(tmp_path / "out" / "trial_HumanPK"))
    assert [tuple(x) for x in back.collect()] == [("CCO", "3")]


def test_paths_outside_the_base(spark, assay, tmp_path):
    outside = config.Settings().merged({"input_path": assay, "base_dir": str(tmp_path)})
    for way in (pipeline.run_tasks, pipeline.run_matrix):
        with pytest.raises(ValueError, match="outside"):
            way(spark, outside)
    with pytest.raises(ValueError, match="outside"):
        pipeline.to_wide_matrix(str(tmp_path / ".." / "x.csv"), spark, base_dir=str(tmp_path))
    inside = config.Settings().merged({"input_path": assay, "base_dir": str(Path(assay).parent)})
    assert pipeline.run_matrix(spark, inside)[0].count() > 0


def test_python_entry(spark, assay):
    raw = readers.read_csv(spark, assay).limit(60)
    out = pipeline.preprocess_frame(raw, "regression")
    assert out.count() == 60 and "measurement_value_scaled" in out.columns and "inferred_pH" in out.columns
    with pytest.raises(quality.TrainingQuorumError):
        pipeline.preprocess_frame(raw.limit(3), "regression")


def test_converter_projection(spark, assay):
    out = pipeline.rename_for_conversion(readers.read_csv(spark, assay))
    assert "compound_id" in out.columns and dict(out.dtypes)["value"] == "double" and out.filter("original_endpoint = 'Solubility'").count() == 3


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("split_method: scaffold  # how\nmin_similarity: 0.7\nmapping_path: null\n")
    got = config.load(str(tmp_path / "c.yaml"), ["--test-size", "0.3", "--split", "--dialect=api"])
    assert (got.split_method, got.min_similarity, got.test_size, got.split, got.dialect) == ("scaffold", 0.7, 0.3, True, "api")
    for wrong in ({"nothing": 1}, {"split_method": "other"}, {"test_size": 0.9, "valid_size": 0.2}):
        with pytest.raises(ValueError):
            config.Settings().merged(wrong)


def test_streams(spark, tmp_path):
    spark.createDataFrame([("a", "5μ", "uM"), ("b", ">2", "hr")], "e string, v string, u string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("e string, v string, u string").parquet(str(tmp_path / "in"))
    run = records.by_batch(records.clean_stream(stream, "v", "u"), lambda x: x, str(tmp_path / "out"), str(tmp_path / "cp"))
    run.processAllAvailable()
    run.stop()
    assert {x.e: x.value_si for x in spark.read.parquet(str(tmp_path / "out")).collect()} == {"a": None, "b": 7200.0}


def test_plans_have_no_python(spark, data):
    for name in ("matrix_mean_pivot", "task_profile_quorum", "unit_to_si", "split_random", "bigram_similarity_match", "lof_1d"):
        plan = registry.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan, name


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, data, name):
    con = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    got = registry.QUERIES[name](spark, data).toPandas()
    want = con.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)

    def normal(df):
        def cell(x):
            if x is None or x != x:
                return "~"
            return f"{round(float(x), 5) + 0.0:.5f}" if not isinstance(x, (str, bool)) and str(x) not in ("True", "False") else str(x)

        return sorted(tuple(map(cell, row)) for row in df[sorted(df.columns)].itertuples(index=False))

    assert normal(got) == normal(want)


def test_queries_reach_their_branches(spark, data):
    """Task kinds, quorums and outlier tests of the queries come out both ways on the data that they run on."""
    quorum = {x.has_quorum for x in registry.QUERIES["class_quorum"](spark, data.replace("sf0.001", "sf0.01")).select("has_quorum").distinct().collect()}
    assert quorum == {True, False}
    gate = stats.normality(session.read_table(spark, data, "orders"), ("o_custkey",), "o_totalprice")
    assert gate.filter("p >= 0.05").count() > 0 and gate.filter("coalesce(p, 0) < 0.05").count() > 0


def test_scratch_deletes_what_is_not_kept(spark):
    """Cuts go with their scratch; kept ones belong to the scratch around, or stay."""
    path = lambda df: Path(df.inputFiles()[0].removeprefix("file:").replace("///", "/")).parent
    with session.Scratch(spark) as outer:
        first = session.cut(spark.range(3), "first")
        with session.Scratch(spark) as inner:
            gone, kept = session.cut(spark.range(4), "gone"), inner.keep(session.cut(spark.range(5), "kept"))
            paths = [path(x) for x in (first, gone, kept)]
        assert [x.exists() for x in paths] == [True, False, True] and kept.count() == 5
        outer.drop(first)
        outer.drop(spark.range(1))
        outer.keep(kept)
    assert [x.exists() for x in paths] == [False, False, True] and kept.count() == 5


def test_small_tables_are_broadcast(spark, monkeypatch):
    names = spark.range(100).selectExpr("id", "repeat('x', 100) AS name")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(session.few(names))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 10_000)
    assert not hinted(session.few(names)) and hinted(session.few(names.limit(0)))


def test_long_work_is_dealt_out(spark, data, monkeypatch):
    """A table that is one file is worked on in tasks of some rows each, however many it has."""
    widest = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.count(F.lit(1)), F.max("count"), F.sum("count")).first()
    tasks, most, rows = widest(registry.motif_features(spark, data))
    assert tasks > 1 and most < rows
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    tasks, most, rows = widest(session.dealt(spark.range(20_000), "id"))
    assert (tasks, rows) == (40, 20_000) and most < 1000
    assert session.dealt(spark.range(0), "id").count() == 0


@pytest.mark.parametrize("made_by", ["groupBy", "join", "repartition"])
def test_row_ids_are_the_same_on_both_sides_of_joins(spark, tmp_path, made_by):
    """Records from an exchange whose partitions are put together anew as columns are pruned: written, counted and collected alike."""
    n = 40_000
    base = spark.range(2 * n).select((F.col("id") % n).cast("string").alias("SMILES_Structure_Parent"), F.col("id").alias("k"), F.lit("1").alias("Measurement_Value"), F.repeat(F.lit("x"), 40).alias("Test"))
    sources = {
        "groupBy": lambda: base.groupBy("k", "SMILES_Structure_Parent").agg(F.first("Measurement_Value").alias("Measurement_Value"), F.first("Test").alias("Test")),
        "join": lambda: base.join(spark.range(2 * n).withColumnRenamed("id", "k").hint("merge"), "k"),
        "repartition": lambda: base.repartition("k"),
    }
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        records = readers.read_records(spark, sources[made_by]().drop("k"))
        kept = dedup.strict_or_first(records, ("Test",), "SMILES_Structure_Parent", "row_id")
        kept.write.parquet(str(tmp_path / "kept"))
        assert (spark.read.parquet(str(tmp_path / "kept")).count(), kept.count(), len(kept.collect())) == (n, n, n)
        parts = split.random_split(records, ("Test",), "row_id")
        parts.write.parquet(str(tmp_path / "parts"))
        back = spark.read.parquet(str(tmp_path / "parts"))
        assert {x["split"]: x["count"] for x in back.groupBy("split").count().collect()} == {"test": 16_000, "valid": 8_000, "train": 56_000}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_scratches_of_two_threads(spark):
    """What one thread cuts is not in the scratch of another, which may end first."""
    begun, ended, alive = threading.Event(), threading.Event(), []

    def slow():
        with session.Scratch(spark):
            begun.set()
            own = session.cut(spark.range(7), "slow")
            ended.wait(60)
            alive.append(own.count())

    thread = threading.Thread(target=slow)
    thread.start()
    begun.wait(60)
    with session.Scratch(spark):
        session.cut(spark.range(3), "fast")
    ended.set()
    thread.join(120)
    assert alive == [7]


def test_no_shared_folder_is_an_error(spark):
    class Bare:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Bare)


def test_named_files_by_command_line(spark, assay, tmp_path):
    """Files as the tasks are called, with all conditions, and again for each split; a second run replaces them."""
    out = tmp_path / "out"
    for _ in range(2):
        assert cli.main(["--input-path", assay, "--split", "--form", "named", "--output-path", str(out)]) == 0
    name = "assay_Physicochem_ClogP" + "_Not_specified" * 8
    found = sorted(str(x.relative_to(out)) for x in out.rglob("*.csv"))
    assert found == [f"{name}_processed.csv"] + [f"splits/{name}_{x}.csv" for x in ("test", "train", "valid")]
    assert len((out / f"{name}_processed.csv").read_text().splitlines()) == 61 and len((out / "splits" / f"{name}_test.csv").read_text().splitlines()) == 13
    assert {x.name for x in out.iterdir() if not x.name.startswith(".")} == {f"{name}_processed.csv", "splits"}


def test_half_done_renames_are_completed(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, f"t {i % 3}", "a/b") for i in range(9)], "x int, task string, u string")
    path = str(tmp_path / "out")
    finish, done = sinks.finish_named, []

    def lost(s, p):
        done.append(p)
        if len(done) > 1:
            raise KeyboardInterrupt
        return finish(s, p)

    monkeypatch.setattr(sinks, "finish_named", lost)
    with pytest.raises(KeyboardInterrupt):
        sinks.write_named(df, path, "b")
    told = json.loads((tmp_path / "out" / sinks.MANIFEST).read_text())
    first, target = told[0]
    Path(first).rename(target)  # one was renamed before the driver was lost
    monkeypatch.undo()
    assert sinks.finish_named(spark, path) and not sinks.finish_named(spark, path)
    assert sorted(x.name for x in (tmp_path / "out").glob("*.csv")) == [f"b_t {k}_processed.csv" for k in range(3)]
    assert sum(len(x.read_text().splitlines()) - 1 for x in (tmp_path / "out").glob("*.csv")) == 9


def test_outside_service(spark, tmp_path):
    """Fifty thousand names and a service that fails at times: all are answered in the end, and none is asked once it was."""
    folder, n = tmp_path / "calls", 50_000
    folder.mkdir()

    def ask(names, folder=str(folder), n=n):
        import os
        import uuid

        if hash(tuple(names)) % 3 == 0 and not os.path.exists(f"{folder}/again"):
            raise ConnectionError("busy")
        with open(f"{folder}/{uuid.uuid4().hex}.txt", "w") as file:
            file.write("\n".join(names))
        return {x: f"E{int(x[1:]) % 7}" for x in names if int(x[1:]) % 10}

    df = spark.range(2 * n).select(F.concat(F.lit("n"), (F.col("id") % n).cast("string")).alias("name"), F.lit(1).alias("endpoint"))
    store = str(tmp_path / "answers")
    first = endpoints.map_by_service(df, "name", ask, store, tries=1, wait=0.0)
    assert first.count() == n and spark.read.option("recursiveFileLookup", True).parquet(store).count() < n
    (folder / "again").touch()
    got = endpoints.map_by_service(df, "name", ask, store, wait=0.0)
    assert got.filter("endpoint <> CASE WHEN cast(substr(name, 2) AS int) % 10 = 0 THEN name ELSE concat('E', cast(substr(name, 2) AS int) % 7) END").count() == 0
    asked = [x for file in folder.glob("*.txt") for x in file.read_text().split("\n")]
    assert len(asked) == len(set(asked)) == n
    calls = len(list(folder.glob("*.txt")))
    assert endpoints.map_by_service(df, "name", ask, store).count() == n
    assert len(list(folder.glob("*.txt"))) == calls


def test_outside_service_by_command_line(spark, assay, tmp_path):
    """A service by its name maps the names; a second run reads its answers; without a service the rules map them."""
    (tmp_path / "own_asker.py").write_text(
        "import json\nimport os\n\n\n"
        "def ask(names):\n"
        f"    if os.path.exists({str(tmp_path / 'closed')!r}):\n        raise ConnectionError('closed')\n"
        "    return '```json\\n' + json.dumps({x: 'DILI' for x in names if 'Nothing' not in x}) + '\\n```'\n"
    )
    spark.sparkContext.addPyFile(str(tmp_path / "own_asker.py"))
    line = ["--input-path", assay, "--to-matrix", "--output-path", str(tmp_path / "out"), "--endpoint-mapper", "llm"]
    asked = [*line, "--mapper-service", "own_asker:ask", "--answers-path", str(tmp_path / "answers")]

    def run(arguments):
        assert cli.main(arguments) == 0
        told = json.loads(spark.read.text(str(tmp_path / "out" / "metadata")).first()[0])
        rows = spark.read.option("header", True).csv(str(tmp_path / "out" / "matrix")).select("smiles", "DILI", "Lipophilicity").orderBy("smiles").collect()
        unmapped = spark.read.option("header", True).csv(str(tmp_path / "out" / "unmapped")).collect()
        return told["mapper"], rows, [x[0] for x in unmapped]

    mapper, rows, unmapped = run(asked)
    assert mapper == "llm" and {float(x.Lipophilicity) for x in rows} == {0.0} and any(float(x.DILI) for x in rows)
    assert unmapped == ["Toxicity | Nothing_known"]
    (tmp_path / "closed").touch()
    assert run(asked) == (mapper, rows, unmapped)
    ruled = run(line)
    assert ruled[0] == "manual" and any(float(x.Lipophilicity) for x in ruled[1])
    for wrong in ("own_asker", "own_asker:nothing", ":ask"):
        with pytest.raises(ValueError, match="package.module:function"):
            endpoints.named_service(wrong)


def test_running_means(spark, tmp_path):
    """Means by window; a row that comes later than the watermark is left out."""
    schema = "e string, p string, v double, t timestamp"
    batches = [[("a", "x", 1.0, "2020-01-01 00:10:00"), ("a", "x", 3.0, "2020-01-01 00:50:00")], [("a", "x", 5.0, "2020-01-01 05:00:00")], [("b", "x", 1.0, "2020-01-01 05:30:00")], [("b", "x", 1.0, "2020-01-01 05:40:00")], [("a", "x", 99.0, "2020-01-01 00:20:00"), ("b", "x", 7.0, "2020-01-01 09:00:00")]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "e string, p string, v double, t string").withColumn("t", F.col("t").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("latestFirst", False).parquet(str(tmp_path / "in"))
    run = records.running_means(stream, "e", "p", "v", "t").writeStream.format("memory").queryName("running").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    run.processAllAvailable()
    run.stop()
    got = {(x.e, x.window.start.hour): (x["mean"], x.n) for x in spark.table("running").collect()}
    assert got[("a", 0)] == (2.0, 2) and got[("a", 5)] == (5.0, 1)
