import json

import pytest

from chronoweave.operators import cohort
from chronoweave.plans import pipeline
from chronoweave.sources import files

SPEC = """
subject_id_col: pid
people:
  eye: {code: 'f"EYE//{$eye}"', time: null}
  born: {code: BIRTH, time: '$dob::"%Y-%m-%d"'}
labs:
  join: {input_prefix: stays, left_on: stay, right_on: stay_id, columns_from_right: [pid]}
  lab:
    code: $test
    time: '$at::"%Y-%m-%dT%H:%M:%S"'
    numeric_value: $result
    _metadata: {names: {description: label}}
meds:
  med:
    code: 'f"{$drug}//{$dose}"'
    time: '$at::"%Y-%m-%dT%H:%M:%S"'
    _metadata: {classes: {_match_on: drug, description: kind}}
stays:
  subject_id_col: pid
"""


@pytest.fixture
def inputs(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "people.csv").write_text("pid,eye,dob\n" + "".join(f"{i},{'brown' if i % 2 else ''},19{50 + i}-01-0{1 + i % 9}\n" for i in range(1, 11)))
    (raw / "stays.csv").write_text("stay_id,pid\n" + "".join(f"{100 + i},{i}\n" for i in range(1, 11)))
    (raw / "labs.csv").write_text("test,stay,at,result\n" + "".join(f"Glucose,{100 + i},2025-03-0{1 + i % 9}T10:00:00,{i}.25\nGlucose,{100 + i},2025-03-0{1 + i % 9}T10:00:00,{i}.25\n" for i in range(1, 11)) + "Sodium,999,2025-01-01T00:00:00,1\n")
    (raw / "meds.csv").write_text("drug,dose,pid,at\nMetformin,500 mg,1,2025-03-16T00:00:00\nMetformin,850 mg,2,2025-03-16T00:00:00\n")
    (raw / "names.csv").write_text("test,label\nGlucose,Blood glucose\nUnseen,No such\n")
    (raw / "classes.csv").write_text("drug,kind\nMetformin,Antidiabetic\n")
    (tmp_path / "spec.yaml").write_text(SPEC)
    return tmp_path


def test_end_to_end(spark, inputs):
    options = pipeline.Options(n_subjects_per_shard=3)
    out = pipeline.run(spark, str(inputs / "spec.yaml"), str(inputs / "raw"), str(inputs / "out"), options)
    events = cohort.read_cohort(spark, out["data"])
    blocks = {r["source_block"]: r["count"] for r in events.groupBy("source_block").count().collect()}
    assert blocks == {"people/eye": 10, "people/born": 10, "labs/lab": 10, "meds/med": 2}
    assert dict(events.dtypes)["numeric_value"] == "float" and dict(events.dtypes)["time"] == "timestamp_ntz"
    assert {r.code for r in events.where("source_block = 'people/eye'").select("code").distinct().collect()} == {"EYE//brown", "EYE//UNK"}
    assert sorted(r.split for r in events.select("split").distinct().collect()) == ["held_out", "train", "tuning"]
    first = spark.read.parquet(f"{out['data']}/train/0.parquet").collect()
    assert [(r.subject_id, r.time is not None) for r in first] == sorted((r.subject_id, r.time is not None) for r in first)
    codes = {r.code: r.description for r in spark.read.parquet(f"{out['metadata']}/codes.parquet").collect()}
    assert codes == {"Glucose": "Blood glucose", "Metformin//500 mg": "Antidiabetic", "Metformin//850 mg": "Antidiabetic"}
    splits = spark.read.parquet(f"{out['metadata']}/subject_splits.parquet")
    assert splits.count() == 10 and splits.columns == ["subject_id", "split"]
    about = json.loads((inputs / "out/metadata/dataset.json").read_text())
    assert about["dataset_name"] == "dataset" and about["subjects_by_split"] == {"train": 8, "tuning": 1, "held_out": 1}
    assert about["rows_by_split"] == {r["split"]: r["count"] for r in events.groupBy("split").count().collect()}
    listed = json.loads((inputs / "out/metadata/.manifest.json").read_text())["files"]
    assert "data/train/0.parquet" in listed and all((inputs / "out" / f).exists() for f in listed)
    assert sorted(p.name for p in (inputs / "out").iterdir()) == ["data", "metadata"]
    assert json.loads((inputs / "out/metadata/.shards.json").read_text())["tuning/0"] == [3]
    with pytest.raises(FileExistsError):
        pipeline.run(spark, str(inputs / "spec.yaml"), str(inputs / "raw"), str(inputs / "out"), options)
    options.do_overwrite = True
    pipeline.run(spark, str(inputs / "spec.yaml"), str(inputs / "raw"), str(inputs / "out"), options)


# fixed values: two subjects of the published small cohort, as they come in and as they must come out, in order
SUBJECTS = """MRN,dob,eye_color,height
239684,12/28/1980,BROWN,175.271115221764
754281,12/19/1988,BROWN,166.22261567137025
"""
VITALS = """subject_id,admit_date,disch_date,department,vitals_date,HR,temp
754281,"01/03/2010, 06:27:59","01/03/2010, 08:22:13",PULMONARY,"01/03/2010, 06:27:59",142.0,99.8
239684,"05/11/2010, 17:41:51","05/11/2010, 19:27:19",CARDIAC,"05/11/2010, 18:57:18",112.6,95.5
239684,"05/11/2010, 17:41:51","05/11/2010, 19:27:19",CARDIAC,"05/11/2010, 17:41:51",102.6,96.0
239684,"05/11/2010, 17:41:51","05/11/2010, 19:27:19",CARDIAC,"05/11/2010, 18:25:35",113.4,95.8
239684,"05/11/2010, 17:41:51","05/11/2010, 19:27:19",CARDIAC,"05/11/2010, 17:48:48",105.1,96.2
"""
SMALL_SPEC = """
subjects:
  subject_id_col: MRN
  eye_color: {code: 'f"EYE_COLOR//{$eye_color}"', time: null}
  height: {code: HEIGHT, time: null, numeric_value: $height}
  dob: {code: DOB, time: '$dob::"%m/%d/%Y"'}
admit_vitals:
  admissions: {code: 'f"ADMISSION//{$department}"', time: '$admit_date::"%m/%d/%Y, %H:%M:%S"'}
  discharge: {code: DISCHARGE, time: '$disch_date::"%m/%d/%Y, %H:%M:%S"'}
  HR: {code: HR, time: '$vitals_date::"%m/%d/%Y, %H:%M:%S"', numeric_value: $HR}
  temp: {code: TEMP, time: '$vitals_date::"%m/%d/%Y, %H:%M:%S"', numeric_value: $temp}
"""
COHORT = """239684,,EYE_COLOR//BROWN,
239684,,HEIGHT,175.271115221764
239684,1980-12-28 00:00:00,DOB,
239684,2010-05-11 17:41:51,ADMISSION//CARDIAC,
239684,2010-05-11 17:41:51,HR,102.6
239684,2010-05-11 17:41:51,TEMP,96.0
239684,2010-05-11 17:48:48,HR,105.1
239684,2010-05-11 17:48:48,TEMP,96.2
239684,2010-05-11 18:25:35,HR,113.4
239684,2010-05-11 18:25:35,TEMP,95.8
239684,2010-05-11 18:57:18,HR,112.6
239684,2010-05-11 18:57:18,TEMP,95.5
239684,2010-05-11 19:27:19,DISCHARGE,
754281,,EYE_COLOR//BROWN,
754281,,HEIGHT,166.22261567137025
754281,1988-12-19 00:00:00,DOB,
754281,2010-01-03 06:27:59,ADMISSION//PULMONARY,
754281,2010-01-03 06:27:59,HR,142.0
754281,2010-01-03 06:27:59,TEMP,99.8
754281,2010-01-03 08:22:13,DISCHARGE,
"""


def test_small_cohort_in_order(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/subjects.csv").write_text(SUBJECTS)
    (tmp_path / "raw/admit_vitals.csv").write_text(VITALS)
    (tmp_path / "spec.yaml").write_text(SMALL_SPEC)
    (tmp_path / "splits.json").write_text(json.dumps({"all": [754281, 239684]}))
    out = pipeline.run(spark, tmp_path / "spec.yaml", tmp_path / "raw", tmp_path / "out", pipeline.Options(external_splits_json_fp=str(tmp_path / "splits.json")))
    rows = spark.read.parquet(f"{out['data']}/all/0.parquet").collect()
    want = [line.split(",") for line in COHORT.splitlines()]
    assert [(str(r.subject_id), str(r.time or ""), r.code) for r in rows] == [tuple(w[:3]) for w in want]
    assert [r.numeric_value for r in rows] == [None if not w[3] else pytest.approx(float(w[3]), rel=1e-6) for w in want]


def test_a_failed_run_leaves_the_old_one(spark, inputs, monkeypatch):
    """A stage fails in the middle, then the move of the second folder: data and metadata stay as they were, and nothing is left behind."""
    args = str(inputs / "spec.yaml"), str(inputs / "raw"), str(inputs / "out")
    pipeline.run(spark, *args, pipeline.Options(n_subjects_per_shard=3))
    inside = lambda: {str(p.relative_to(inputs)): p.read_bytes() for p in (inputs / "out").rglob("*") if p.is_file()}
    before = inside()
    more = pipeline.Options(n_subjects_per_shard=5, do_overwrite=True)

    def broken(context):
        raise RuntimeError("half way")

    with monkeypatch.context() as m:
        m.setitem(pipeline.STAGES, "codes", broken)
        with pytest.raises(RuntimeError, match="half way"):
            pipeline.run(spark, *args, more)
    assert inside() == before
    move = files.move

    def refuses(spark, source, target, storage=None):
        if target.endswith("out/metadata") and ".old" not in source:
            raise OSError("no")
        move(spark, source, target, storage)

    with monkeypatch.context() as m:
        m.setattr(files, "move", refuses)
        with pytest.raises(OSError, match="no"):
            pipeline.run(spark, *args, more)
    assert inside() == before
    pipeline.run(spark, *args, more)
    assert inside() != before and sorted(p.name for p in (inputs / "out").iterdir()) == ["data", "metadata"]


def test_nothing_is_left_in_the_shared_folder(spark, inputs):
    from pathlib import Path

    shared = Path(files.shared_dir(spark).removeprefix("file://"))
    before = {p.name for p in shared.iterdir()}
    pipeline.run(spark, str(inputs / "spec.yaml"), str(inputs / "raw"), str(inputs / "out"), pipeline.Options(n_subjects_per_shard=3))
    assert {p.name for p in shared.iterdir()} == before


def test_existing_codes_are_joined(spark, inputs):
    """codes.parquet in the input's metadata folder: its codes stay, new ones come to it, clashing columns stand side by side."""
    rows = spark.createDataFrame([("EXISTING", "An old code"), ("Glucose", "Sugar")], "code string, description string")
    rows.coalesce(1).write.parquet(str(inputs / "raw/metadata/codes.parquet"))
    out = pipeline.run(spark, str(inputs / "spec.yaml"), str(inputs / "raw"), str(inputs / "out"))
    got = {r.code: (r.description, r.description_right) for r in spark.read.parquet(f"{out['metadata']}/codes.parquet").collect()}
    assert got["EXISTING"] == ("An old code", None) and got["Glucose"] == ("Sugar", "Blood glucose") and got["Metformin//500 mg"] == (None, "Antidiabetic")
    with pytest.raises(FileNotFoundError, match="nowhere"):
        pipeline.run(spark, str(inputs / "spec.yaml"), str(inputs / "raw"), str(inputs / "out2"), pipeline.Options(existing_codes_fp=f"{inputs}/nowhere.parquet"))


def test_storage_settings_reach_readers_writers_and_file_calls(spark, inputs):
    """A file system without checksum files, set for one run: neither tables nor small files get any; the session stays as it was."""
    raw = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
    for name, storage in (("plain", {}), ("raw", raw)):
        pipeline.run(spark, f"file://{inputs}/spec.yaml", f"file://{inputs}/raw", f"file://{inputs}/{name}", pipeline.Options(storage=storage))
        sums = {p.relative_to(inputs / name).parts[0] for p in (inputs / name).rglob("*.crc")}
        assert sums == (set() if storage else {"data", "metadata"})
    assert spark._jsc.hadoopConfiguration().get("fs.file.impl") is None


def test_ties_come_out_in_input_order(spark, tmp_path):
    """Two files whose rows tie in subject, time and block: files in order of name, rows as they stand, in CSV and Parquet."""
    for kind in ("csv", "parquet"):
        root = tmp_path / kind
        (root / "raw/t").mkdir(parents=True)
        words = ["pear", "apple", "plum", "fig", "date", "lime"]
        for i in range(2):
            own = words[3 * i : 3 * i + 3]
            if kind == "csv":
                (root / f"raw/t/p{i}.csv").write_text("subject_id,word,at\n" + "".join(f"1,{w},2020-01-01\n" for w in own))
            else:
                spark.createDataFrame([(1, w, "2020-01-01") for w in own], "subject_id long, word string, at string").coalesce(1).write.parquet(str(root / f"w{i}"))
                next((root / f"w{i}").glob("*.parquet")).rename(root / f"raw/t/p{i}.parquet")
        (root / "spec.yaml").write_text("t:\n  e: {code: $word, time: '$at::\"%Y-%m-%d\"'}\n")
        (root / "splits.json").write_text(json.dumps({"all": [1]}))
        for layout in ("shards", "ranges"):
            out = pipeline.run(spark, f"{root}/spec.yaml", f"{root}/raw", f"{root}/{layout}", pipeline.Options(external_splits_json_fp=f"{root}/splits.json", layout=layout))
            rows = spark.read.parquet(f"{out['data']}/all/0.parquet" if layout == "shards" else f"{out['data']}/split=all/shard=0")
            assert [r.code for r in rows.collect()] == words


def test_command_line(spark, inputs, capsys):
    from chronoweave.__main__ import main

    main([str(inputs / "spec.yaml"), str(inputs / "raw"), str(inputs / "out"), "n_subjects_per_shard=3", "split_fracs={train: 0.8, held_out: 0.2}"])
    assert "metadata" in capsys.readouterr().out
    assert sorted(json.loads((inputs / "out/metadata/.shards.json").read_text())) == ["held_out/0", "train/0", "train/1", "train/2"]
    with pytest.raises(SystemExit):
        main(["spec.yaml"])


def test_missing_inputs(spark, inputs):
    with pytest.raises(FileNotFoundError):
        pipeline.run(spark, str(inputs / "nothing.yaml"), str(inputs / "raw"), str(inputs / "out2"))
    (inputs / "raw/meds.csv").unlink()
    with pytest.raises(FileNotFoundError, match="meds"):
        pipeline.run(spark, str(inputs / "spec.yaml"), str(inputs / "raw"), str(inputs / "out2"))


def test_metadata_folder_name(spark, tmp_path):
    with pytest.raises(ValueError, match="metadata"):
        pipeline.finish_metadata(spark.createDataFrame([], "code string"), spark.createDataFrame([], "subject_id long, split string"), tmp_path / "other", "overwrite", pipeline.Options())


def test_stages_of_ones_own(spark, inputs):
    @pipeline.stage("count-subjects")
    def count(context):
        context.tables["n"] = context.tables["shards"].agg({"subject_id": "count"})
        seen.append(context.tables["n"].first()[0])

    seen = []
    try:
        pipeline.run(spark, f"file://{inputs}/spec.yaml", f"file://{inputs}/raw", f"file://{inputs}/out", pipeline.Options(split_by="hash"), ["raw_tables", "subjects", "count-subjects", "cohort"])
        with pytest.raises(KeyError, match="no stage nothing"):
            pipeline.stage_named("nothing")
        with pytest.raises(ValueError, match="registered"):
            pipeline.stage("count-subjects")(count)
    finally:
        del pipeline.STAGES["count-subjects"]
    assert seen == [10] and (inputs / "out/data").exists() and not (inputs / "out/metadata").exists()
    with pytest.raises(FileExistsError):
        pipeline.run(spark, f"{inputs}/spec.yaml", f"{inputs}/raw", f"{inputs}/out")


def test_stream(spark, tmp_path):
    from chronoweave.plans import spec
    from chronoweave.streaming.events import stream_events

    src = tmp_path / "in"
    spark.createDataFrame([(1, "a", "2020-01-01 00:00:00"), (1, "a", "2020-01-01 00:00:00"), (2, "b", "2020-01-02 00:00:00")], "subject_id long, k string, at string").coalesce(1).write.parquet(str(src))
    t = spec.from_dict({"t": {"e": {"code": "$k", "time": '$at::"%Y-%m-%d %H:%M:%S"'}}}).tables["t"]
    raw = spark.readStream.schema("subject_id long, k string, at string").parquet(str(src))
    for mark, n in ((None, 3), ("1 day", 2)):
        q = stream_events(raw, t, watermark=mark).writeStream.format("memory").queryName(f"s{n}").option("checkpointLocation", str(tmp_path / f"c{n}")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert spark.table(f"s{n}").count() == n


def test_shard_map_of_a_run_does_not_pass_the_driver(spark, monkeypatch):
    """Neither when it is written nor when the query on splits reads it."""
    from chronoweave.plans import catalogue

    def refused(*_, **__):
        raise AssertionError("rows come to the driver")

    read_text = pipeline.files.read_text
    monkeypatch.setattr(catalogue, "_runs", {})
    monkeypatch.setattr(type(spark.range(1)), "toLocalIterator", refused)
    monkeypatch.setattr(pipeline.files, "read_text", lambda s, path, *a: refused() if str(path).endswith(".shards.json") else read_text(s, path, *a))
    got = catalogue.queries()["whole_run_splits"](spark, "/root/testdata/sf0.001").collect()
    assert got and all((r.n_shards, r.same) == (1, True) for r in got)
