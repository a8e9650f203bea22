import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import align, codes, cohort, subjects
from chronoweave.operators.order import numbered
from chronoweave.operators.events import extract_event, lookup_join, table_events
from chronoweave.operators.union import diagonal_union, vertical_union
from chronoweave.plans import spec


def test_diagonal_union_meets_in_supertypes(spark):
    a = spark.sql("SELECT 1 AS x, struct(1 AS p) AS s, DATE'2020-01-01' AS t")
    b = spark.sql("SELECT 'k' AS x, struct('z' AS q) AS s, TIMESTAMP_NTZ'2020-01-01 01:00:00' AS t, 2.5D AS extra")
    got = diagonal_union([a, b]).orderBy("x").collect()
    assert [(r.x, r.s, r.t, r.extra) for r in got] == [("1", (1, None), dt.datetime(2020, 1, 1), None), ("k", (None, "z"), dt.datetime(2020, 1, 1, 1), 2.5)]
    with pytest.raises(ValueError, match="differ"):
        vertical_union([a.select("x"), b.select("x")])


def test_lookup_join_renames_clashes_and_keeps_unmatched(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "r")], "id int, v string")
    got = lookup_join(left, right, spec.Join("r", "k", "id", ("v",))).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", "r"), (2, "b", None)]


def block(cfg):
    return spec.event("t", "e", cfg)


def test_unknown_pieces_and_components(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, "u"), (1, None, None), (1, None, None)], "subject_id int, x string, y string")
    got = extract_event(df, block({"code": 'f"{$x}//{$y}"', "time": None}))
    assert sorted(r.code for r in got.collect()) == ["UNK//UNK", "UNK//u", "a//UNK"]
    assert got.schema["time"].dataType.simpleString() == "timestamp_ntz"
    assert {tuple(r.code_components) for r in got.collect()} == {("a", None), (None, "u"), (None, None)}


def test_filters_test_sources_not_values(spark):
    df = spark.createDataFrame([(1, "a", "2020-01-01"), (1, "", "bad"), (1, None, "2020-01-01"), (1, "b", ""), (1, "c", None)], "subject_id int, x string, d string")
    got = extract_event(df, block({"code": "$x", "time": '$d as ?"%Y-%m-%d"'})).collect()
    assert sorted((r.code, r.time) for r in got) == [("", None), ("a", dt.date(2020, 1, 1))]


def test_text_that_repeats_the_number_goes(spark):
    df = spark.createDataFrame([(1, 1.5, "1.50"), (1, 1.5, "1.5d"), (1, 1.5, "high"), (1, None, "1.5")], "subject_id int, v double, s string")
    cfg = {"code": "L", "time": None, "numeric_value": "$v", "text_value": "$s"}
    assert sorted(str(r.text_value) for r in extract_event(df, block(cfg)).collect()) == ["1.5", "1.5d", "None", "high"]
    assert extract_event(df, block(cfg), dedup_text=False).where("text_value is null").count() == 0


def test_errors_name_the_block(spark):
    df = spark.createDataFrame([(1,)], "subject_id int")
    with pytest.raises(ValueError, match="Error extracting event t/e"):
        extract_event(df, block({"code": "$nope", "time": None}))


def test_transforms_and_ids(spark):
    raw = spark.createDataFrame([("m1", 2)], "mrn string, v int")
    t = spec.from_dict({"t": {"subject_id_expr": "hash($mrn)", "transforms": {"w": "$v * 2"}, "e": {"code": "W", "time": None, "numeric_value": "$w"}}}).tables["t"]
    got = table_events(raw, t).first()
    assert got.numeric_value == 4 and got.subject_id == raw.select(F.xxhash64("mrn")).first()[0]


def test_shards_golden():
    assert subjects.assign_shards(range(10, 0, -1), 3) == {"train/0": [9, 4, 8], "train/1": [2, 1, 10], "train/2": [6, 5], "tuning/0": [3], "held_out/0": [7]}
    assert subjects.assign_shards(range(1, 11), 3, shares={"train": 0.8, "tuning": 0.2, "held_out": None}) == {"train/0": [5, 9, 6], "train/1": [3, 10, 8], "train/2": [1, 2], "tuning/0": [7, 4]}
    external = {"taskA/held_out": [8, 9, 10], "taskB/held_out": [10, 8, 9]}
    assert subjects.assign_shards(range(1, 11), 3, external) == {"train/0": [5, 7, 4], "train/1": [1, 2], "tuning/0": [3], "held_out/0": [6], "taskA/held_out/0": [8, 9, 10], "taskB/held_out/0": [10, 8, 9]}
    lists = {"train": [1, 2, 3, 4, 5, 6], "test": [7, 8, 9, 10]}
    assert subjects.assign_shards(range(1, 11), 6, lists) == {"train/0": [1, 2, 3, 4, 5, 6], "test/0": [7, 8, 9, 10]}
    assert subjects.assign_shards(range(1, 11), 3, lists) == {"train/0": [5, 1, 3], "train/1": [2, 6, 4], "test/0": [10, 7], "test/1": [8, 9]}
    with pytest.raises(ValueError, match="add up to 1"):
        subjects.assign_shards(range(10), 3, shares={"train": 0.8, "held_out": None})
    with pytest.raises(ValueError, match="cannot fill"):
        subjects.assign_shards([1, 2], 3)
    assert subjects.assign_shards([1], 3, {"only": [1]}) == {"only/0": [1]}
    assert subjects.split_of("taskA/held_out/0") == "taskA/held_out"


def test_shards_on_dataframes_equal_those_of_lists(spark, tmp_path):
    def as_lists(df):
        out = {}
        for r in sorted(df.collect(), key=lambda r: (r.shard, r.place)):
            assert r.place == len(out.setdefault(r.shard, []))
            out[r.shard].append(r.subject_id)
        return out

    big = [7 * i - 2**62 for i in range(50)] + [2**62 + i for i in range(7)]  # further apart than a long holds
    cases = [(list(range(1, 11)), 3, None), (big, 4, None), (list(range(1, 11)), 3, {"taskA/held_out": [8, 9, 10, 4], "b": [10, 8, 99]}), ([1, 2], 3, {"only": [2, 1]})]
    for ids, per, external in cases:
        people = spark.createDataFrame([(i,) for i in reversed(ids)], "subject_id bigint")
        lists = None
        if external:
            for name in ("splits.json", ".shards.json"):
                (tmp_path / name).write_text(json.dumps(external))
                lists = subjects.external_splits(spark, tmp_path / name)
                assert sorted(map(tuple, lists.collect())) == sorted((k, n, i, v) for n, (k, own) in enumerate(external.items()) for i, v in enumerate(own))
        assert as_lists(subjects.drawn_shards(people, per, lists)) == subjects.assign_shards(ids, per, external)
        hashed = as_lists(subjects.hashed_shards(people, per, lists))
        drawn = subjects.assign_shards(ids, per, external)
        free = set(ids) - {i for v in (external or {}).values() for i in v}
        assert {i for k, v in hashed.items() if subjects.split_of(k) in subjects.DEFAULT_SHARES for i in v} == free
        assert sorted(len(v) for v in hashed.values()) == sorted(len(v) for v in drawn.values())
    assert numbered(people.limit(0), "subject_id", "place").count() == 0
    with pytest.raises(ValueError, match="split_by"):
        subjects.drawn_shards(people, most=1)


def test_one_scan_for_all_blocks_of_a_table(spark, tmp_path):
    for name in ("people", "stays"):
        spark.range(5).selectExpr("id AS pid", "id AS stay", "'a' AS x", "'2020-01-01' AS d").write.parquet(str(tmp_path / name))
    cfg = {"subject_id_col": "pid", "people": {"join": {"input_prefix": "stays", "left_on": "stay", "right_on": "stay", "columns_from_right": ["x"]}, "a": {"code": "$x", "time": None}, "b": {"code": 'f"{$x}//{$d}"', "time": '$d::"%Y-%m-%d"'}, "c": {"code": "C", "time": '$d::"%Y-%m-%d"', "numeric_value": "$stay"}}}
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    got = table_events(read("people"), spec.from_dict(cfg).tables["people"], read("stays"), distinct=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and got.count() == 15
    assert {(r.code, r.code_components, r.numeric_value) for r in got.where("subject_id = 3").collect()} == {("a", (None, "a"), None), ("a//2020-01-01", ("2020-01-01", "a"), None), ("C", None, 3)}


def test_universe_drops_null_and_nan(spark):
    a = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "subject_id double")
    b = spark.createDataFrame([(1,), (2,)], "subject_id int")
    assert sorted(r.subject_id for r in subjects.universe([a, b]).collect()) == [1, 2]


def test_distinct_and_order(spark):
    rows = spark.createDataFrame([(1, None, "B", 0, 1), (1, None, "A", 0, 0), (1, 5, "C", 1, 0), (1, 5, "C", 0, 2), (1, 4, "Z", 1, 0)], "subject_id int, time int, code string, __table__ int, __block__ int").withColumns({"shard": F.lit("s/0"), "split": F.lit("s")})
    got = cohort.ordered(cohort.distinct_events(rows)).collect()
    assert [(r.time, r.code) for r in got] == [(None, "A"), (None, "B"), (4, "Z"), (5, "C")]
    assert cohort.distinct_events(rows, ["time"]).count() == 3
    assert cohort.distinct_events(rows, None).count() == 5
    with pytest.raises(ValueError, match="unique_by"):
        cohort.distinct_events(rows, [])


def test_one_shuffle_writes_the_cohort(spark):
    rows = spark.range(100).select(F.col("id").alias("subject_id"), F.lit(None).cast("timestamp_ntz").alias("time"), F.lit("c").alias("code"), F.concat(F.lit("s/"), (F.col("id") % 3).cast("string")).alias("shard"), F.lit("s").alias("split"))
    for by, own, other in (("ranges", "rangepartitioning", "hashpartitioning"), ("shards", "hashpartitioning", "rangepartitioning")):
        plan = cohort.ordered(rows, by=by)._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"Exchange {own}") == 1 and other not in plan
    with pytest.raises(ValueError, match="ranges"):
        cohort.ordered(rows, by="rows")


def test_input_order_is_the_last_tie(spark):
    """Equal in subject, time and block: rows come out in the order of the raw table, whatever their other values are."""
    rows = spark.createDataFrame([(1, 5, v, 0, 0, at) for at, v in enumerate(["z", "a", "m", "a", "z", "b"])], "subject_id int, time int, code string, __table__ int, __block__ int, __row__ long").withColumns({"shard": F.lit("s/0"), "split": F.lit("s")})
    assert [r.code for r in cohort.ordered(cohort.distinct_events(rows)).collect()] == ["z", "a", "m", "b"]
    assert [r.code for r in cohort.ordered(cohort.distinct_events(rows, ["code"])).collect()] == ["z", "a", "m", "b"]
    assert [r.code for r in cohort.ordered(rows).collect()] == ["z", "a", "m", "a", "z", "b"]
    # without a block's name equal rows of two blocks are one; the place in the specification counts before the position
    two = rows.withColumns({"__block__": F.when(F.col("__row__") % 2 == 0, 1).otherwise(0)})
    kept = {(r.code, r["__block__"], r["__row__"]) for r in cohort.distinct_events(two).collect()}
    assert kept == {("z", 1, 0), ("a", 0, 1), ("m", 1, 2), ("b", 0, 5)}


def test_distinct_by_list_combines_before_the_shuffle(spark):
    """One subject has nearly all rows; no window sorts them in one task."""
    rows = spark.range(2000).select(F.lit(7).alias("subject_id"), (F.col("id") % 3).alias("time"), F.col("id").cast("string").alias("code"), F.lit(0).alias("__table__"), F.lit(0).alias("__block__"), F.col("id").alias("__row__"), F.lit("s/0").alias("shard"))
    got = cohort.distinct_events(rows.repartition(4), ["subject_id", "time"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("SortAggregate") == 2
    assert sorted((r.time, r.code) for r in got.collect()) == [(0, "0"), (1, "1"), (2, "2")]


def test_lookup_of_the_id_is_an_inner_join(spark, tmp_path):
    """Where the id comes from the lookup, rows without a match make no event: Spark may filter by the other side, or broadcast either."""
    for name in ("stays", "labs"):
        spark.range(50).selectExpr("id AS stay", "id * 2 AS pid_", "'a' AS x").write.parquet(str(tmp_path / name))
    stays, labs = (spark.read.parquet(str(tmp_path / n)) for n in ("stays", "labs"))
    cfg = {"labs": {"join": {"input_prefix": "stays", "left_on": "stay", "right_on": "stay", "columns_from_right": ["pid"]}, "subject_id_col": "pid", "e": {"code": "$x", "time": None}}}
    t = spec.from_dict(cfg).tables["labs"]
    found = table_events(labs.drop("pid_"), t, stays.withColumnRenamed("pid_", "pid").where("pid < 20"), distinct=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Inner" in plan and "LeftOuter" not in plan and found.count() == 10
    own = {**cfg["labs"], "subject_id_col": "stay"}
    left = table_events(labs.drop("pid_"), spec.from_dict({"labs": own}).tables["labs"], stays.withColumnRenamed("pid_", "pid").where("pid < 20"), distinct=False)
    assert "LeftOuter" in left._jdf.queryExecution().executedPlan().toString() or left.count() == 50
    assert left.count() == 50


def test_numbers_with_one_far_value(spark):
    ids = [*range(5000), 2**61, -(2**61)]
    got = numbered(spark.createDataFrame([(i,) for i in ids], "k long"), "k", "n", 16)
    assert [r.k for r in got.orderBy("n").collect()] == sorted(ids) and [r.n for r in got.orderBy("n").collect()] == list(range(len(ids)))


def test_align(spark):
    got = align.align_events(spark.createDataFrame([("c", "1.5", 7, "x")], "code string, numeric_value string, subject_id int, more string").withColumn("time", F.lit(None)))
    assert got.dtypes == [("subject_id", "bigint"), ("time", "timestamp_ntz"), ("code", "string"), ("numeric_value", "float"), ("more", "string")]
    with pytest.raises(ValueError, match="mandatory"):
        align.align_codes(spark.range(1))


def test_codes_reduce_shapes(spark):
    one = spark.createDataFrame([("A", "a", "L1")], "code string, description string, loinc string")
    two = spark.createDataFrame([("A", "b", None), ("B", None, "L2")], "code string, description string, loinc string")
    single = codes.reduce_codes([one])
    assert dict(single.dtypes)["loinc"] == "string"
    got = {r.code: r for r in codes.reduce_codes([one, two]).collect()}
    assert (got["A"].description, got["A"].loinc, got["B"].description, got["B"].loinc) == ("a\nb", ["L1", None], None, ["L2"])


def test_metadata_errors(spark):
    meta = spark.createDataFrame([("x", "d")], "name string, descr string")
    e = block({"code": 'f"{$name}"', "time": None})
    with pytest.raises(KeyError, match="_match_on"):
        codes.code_metadata(meta, e, {"_match_on": "other", "description": "descr"})
    with pytest.raises(KeyError, match="lacks columns"):
        codes.code_metadata(meta, e, {"description": "nope"})
    assert codes.expand_partial(meta, None, ["name"]) is None


def test_spec_errors():
    for cfg, error in (({"time": None}, KeyError), ({"code": "A"}, KeyError), ({"code": None, "time": None}, ValueError), ({"code": "A", "time": None, "v": 3}, ValueError), ({"code": "A", "time": None, "_metadata": {}}, KeyError), ({"code": "A", "time": None, "_metadata": "x"}, TypeError)):
        with pytest.raises(error):
            block(cfg)
    need = spec.required_columns(spec.from_dict({"v": {"join": {"input_prefix": "s", "left_on": "k", "right_on": "id", "columns_from_right": ["subject_id"]}, "transforms": {"w": "$x"}, "e": {"code": "$w", "time": None}}}))
    assert need == {"v": ["k", "x"], "s": ["id", "subject_id"]}


def test_a_draw_of_more_than_five_million(spark):
    """Twenty million subjects may be drawn, and a row of the drawn numbers holds many of them."""
    assert subjects.MOST_DRAWN >= 6_000_000
    ids = list(range(3, 25_000, 2))
    people = spark.createDataFrame([(i,) for i in ids], "subject_id bigint")
    lists = spark.createDataFrame([("b", 0, k, i) for k, i in enumerate(ids[:11_000])] + [("c", 1, 0, 3)], "split string, number int, place bigint, subject_id bigint")
    for external, want in ((None, subjects.assign_shards(ids, 500)), (lists, subjects.assign_shards(ids, 500, {"b": ids[:11_000], "c": [3]}))):
        got: dict[str, list] = {}
        for r in sorted(subjects.drawn_shards(people, 500, external).collect(), key=lambda r: (r.shard, r.place)):
            got.setdefault(r.shard, []).append(r.subject_id)
        assert got == want


def test_files_of_a_raw_table_grow_with_it(spark, monkeypatch):
    """A gzipped file is one task's work, so a larger table is written in more of them."""
    from chronoweave.plans import catalogue

    monkeypatch.setattr(catalogue, "_FILE_ROWS", 100)
    assert [catalogue._parts(spark.range(n)) for n in (0, 250, 301, 1000)] == [3, 3, 4, 10]


def test_a_shard_of_several_files_is_read_in_order(spark, tmp_path):
    """A shard whose rows span tasks is written in several named files, numbered through."""
    rows = spark.range(3000).select((2999 - F.col("id")).alias("subject_id"), F.lit(None).cast("timestamp_ntz").alias("time"), F.lit("c").alias("code"), F.concat(F.lit("s/"), (F.col("id") % 2).cast("string")).alias("shard"), F.lit("s").alias("split"))
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "26")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cohort.write_cohort(cohort.ordered(rows, by="ranges"), str(tmp_path / "out"), named=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])
    assert len(list((tmp_path / "out/s").glob("0*.parquet"))) > 10  # so that 0-10 must not come before 0-2
    got = cohort.read_in_order(spark, str(tmp_path / "out"), "n").collect()
    assert len(got) == 3000 and all(r.subject_id // 2 == r.n for r in got)


def test_draw_of_sizes_that_the_sql_does_not_list():
    """The SQL of iid_split lists 150 and 1,500 subjects; the same independent definition holds for others."""
    from chronoweave.plans import catalogue

    shards = subjects.assign_shards(range(15_000), 500)
    got = {i: f"{shard}:{place}" for shard, own in shards.items() for place, i in enumerate(own)}
    assert [got[i] for i in range(15_000)] == catalogue._drawn(15_000)


def test_permutations_by_tasks_equal_numpys(spark, monkeypatch):
    """Of any size, one draw after the other, whatever the tasks' shares."""
    monkeypatch.setattr(subjects, "SWAPS", 70)
    sizes = {0: 1000, 1: 1, 2: 2, 3: 281, 4: 71}
    ours, numpys = np.random.default_rng(1), np.random.default_rng(1)
    got = subjects.permutations(spark, ours, sizes).collect()
    for d, n in sizes.items():
        assert sorted((r["at"], r["number"]) for r in got if r["draw"] == d) == list(enumerate(numpys.permutation(n).tolist()))
    assert ours.bit_generator.state == numpys.bit_generator.state


def test_many_subjects_are_drawn_by_tasks(spark, monkeypatch):
    """The same shards as a draw on the driver, which neither draws nor broadcasts what grows with the subjects."""
    ids = list(range(3, 6000, 2))
    lists = [("b", 0, k, i) for k, i in enumerate(ids[:1100])] + [("c", 1, 0, 3)]
    want = [subjects.assign_shards(ids, 300), subjects.assign_shards(ids, 300, {"b": ids[:1100], "c": [3]})]

    def refused(*_):
        raise AssertionError("drawn on the driver")

    monkeypatch.setattr(subjects, "draw", refused)
    monkeypatch.setattr(subjects, "FEW", 1000, raising=False)
    monkeypatch.setattr(subjects, "SWAPS", 700, raising=False)
    people = spark.createDataFrame([(i,) for i in ids], "subject_id bigint")
    for external, shards in zip((None, spark.createDataFrame(lists, "split string, number int, place bigint, subject_id bigint")), want):
        found = subjects.drawn_shards(people, 300, external)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastExchange") <= 1  # one row a range of ids
        got: dict[str, list] = {}
        for r in sorted(found.collect(), key=lambda r: (r.shard, r.place)):
            assert r.place == len(got.setdefault(r.shard, []))
            got[r.shard].append(r.subject_id)
        assert got == shards


def test_shard_map_is_written_and_read_by_tasks(spark, tmp_path, monkeypatch):
    """A line a shard, in order of name; read by several tasks, whose lists keep the file's order."""
    names = [f's"{i % 3}/x\\y/{i}' for i in range(40)]
    ids = spark.range(3000).select((F.col("id") - 1500).alias("subject_id"), F.element_at(F.lit(names), (F.col("id") % 40 + 1).cast("int")).alias("shard"), F.floor((2999 - F.col("id")) / 40).alias("place"))
    path = str(tmp_path / ".shards.json")
    subjects.write_lists(ids, path)
    want: dict[str, list] = {}
    for r in sorted(ids.collect(), key=lambda r: r.place):
        want.setdefault(r.shard, []).append(r.subject_id)
    found = json.loads((tmp_path / ".shards.json").read_text())
    assert found == want and list(found) == sorted(want) and [f.name for f in tmp_path.iterdir() if f.suffix != ".crc"] == [".shards.json"]

    def refused(*_):
        raise AssertionError("read by the driver")

    monkeypatch.setattr(subjects.files, "read_text", refused)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "1000")
    try:
        lists = subjects.external_splits(spark, path)
        assert lists.rdd.getNumPartitions() > 5
        rows = sorted(lists.collect(), key=lambda r: (r.number, r.place))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [(r.split, r.place, r.subject_id) for r in rows] == [(k, i, v) for k in sorted(want) for i, v in enumerate(want[k])]
    subjects.write_lists(ids.limit(0), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == {} and subjects.external_splits(spark, tmp_path / "none.json").count() == 0
    with pytest.raises(FileNotFoundError):
        subjects.external_splits(spark, tmp_path / ".nothing.json")
