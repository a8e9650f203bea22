"""From raw files to a finished cohort: one lazy plan for the events, one small plan for the codes."""

from __future__ import annotations

import datetime
import json
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from importlib.metadata import entry_points

import yaml
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import align, codes, cohort, subjects
from ..operators.events import subject_rows, table_events
from ..operators.union import diagonal_union
from ..sources import files, readers
from ..sources.files import materialize
from .spec import Spec, from_dict, required_columns

log = logging.getLogger(__name__)


@dataclass
class Options:
    """Knobs with their defaults."""

    n_subjects_per_shard: int = 50_000
    split_fracs: dict[str, float | None] = field(default_factory=lambda: dict(subjects.DEFAULT_SHARES))
    external_splits_json_fp: str | None = None
    seed: int = 1
    do_dedup_text_and_numeric: bool = True
    unique_by: str | list[str] | None = "*"
    additional_sort_by: list[str] | None = None
    description_separator: str = "\n"
    code_modifiers: list[str] | None = None
    do_overwrite: bool = False
    #: draw: numbers come from a seeded NumPy generator; hash: subjects in order of a seeded hash, for any number of them.
    split_by: str = "draw"
    #: More subjects than a draw may have are an error.
    max_drawn_subjects: int = subjects.MOST_DRAWN
    dataset_name: str = "dataset"
    dataset_version: str = "1"
    #: shards: one file ``{split}/{shard}.parquet`` each, sorted in one task; ranges: folders ``split=/shard=`` of several files, for
    #: shards or subjects of more rows than a task should sort.
    layout: str = "shards"
    #: A code dictionary that the new one is joined to; by default ``metadata/codes.parquet`` or ``codes.parquet`` below the input, if there.
    existing_codes_fp: str | None = None
    #: Settings of the storage, such as ``fs.s3a.bucket.raw.endpoint``, for the accesses of this run alone.
    storage: dict[str, str] = field(default_factory=dict)


Reader = Callable[[str], DataFrame]


def session(builder=None) -> SparkSession:
    """A session with the settings that the plans rely on: UTC, timestamps without zone, ANSI, adaptive execution."""
    b = builder or SparkSession.builder
    conf = {"spark.sql.session.timeZone": "UTC", "spark.sql.timestampType": "TIMESTAMP_NTZ", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true"}
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def events_of(spec: Spec, read: Reader, options: Options | None = None, distinct: bool = False) -> DataFrame:
    """All events of all tables with their place in the specification; lazily, no shuffle unless a lookup join needs one."""
    options = options or Options()
    frames = []
    for i, t in enumerate(spec.tables.values()):
        if not t.events:
            continue
        lookup = read(t.join.table) if t.join else None
        frames.append(table_events(read(t.name), t, lookup, distinct, options.do_dedup_text_and_numeric).withColumn("__table__", F.lit(i)))
    if not frames:
        raise ValueError("the specification has no events")
    return diagonal_union(frames)


def subjects_of(spec: Spec, read: Reader) -> DataFrame:
    """Distinct subjects of all tables, those without events included."""
    return subjects.universe([subject_rows(read(t.name), t, read(t.join.table) if t.join else None) for t in spec.tables.values()])


def shards_of(spark: SparkSession, people: DataFrame, options: Options, external: DataFrame | None = None) -> DataFrame:
    """(subject_id, split, shard, place) by the way that the options name."""
    if external is None and options.external_splits_json_fp:
        external = subjects.external_splits(spark, options.external_splits_json_fp, options.storage)
    if options.split_by == "hash":
        return subjects.hashed_shards(people, options.n_subjects_per_shard, external, options.split_fracs, options.seed)
    if options.split_by != "draw":
        raise ValueError(f"split_by must be 'draw' or 'hash', not {options.split_by!r}")
    return subjects.drawn_shards(people, options.n_subjects_per_shard, external, options.split_fracs, options.seed, options.max_drawn_subjects)


def cohort_of(events: DataFrame, shards: DataFrame, options: Options | None = None) -> DataFrame:
    """Routed, distinct, ordered and aligned events, with split and shard.

    Rows that are equal in all columns go before routing: they are dealt by all columns, after each task has dropped its own, so a
    subject with very many rows is no one task's work; nor is it in the join, whose skewed partitions adaptive execution splits.
    """
    options = options or Options()
    if options.unique_by == "*":
        rows = cohort.route(cohort.distinct_events(events), shards)
    else:
        rows = cohort.distinct_events(cohort.route(events, shards), options.unique_by)
    if options.layout == "ranges":
        # ranges come from a sample of the rows, which would be made twice otherwise
        rows = materialize(rows, "routed")
    return align.align_events(cohort.ordered(rows, options.additional_sort_by, options.layout))


def codes_of(spec: Spec, read_metadata: Reader, events: DataFrame, options: Options | None = None, existing: DataFrame | None = None) -> DataFrame | None:
    """The code dictionary; None if no block has metadata. The events are read once, for their distinct codes and components."""
    options = options or Options()
    blocks = [e for e in spec.events if e.metadata]
    if not blocks:
        return existing
    seen = materialize(events.select("code", *[c for c in ("code_components",) if c in events.columns]).distinct(), "observed")
    observed, parts = seen.select("code").distinct(), codes.component_map(seen)
    frames = []
    for e in blocks:
        for table, cfg in e.metadata.items():
            got = codes.code_metadata(read_metadata(table), e, cfg, observed)
            if "_match_on" in cfg:
                on = [cfg["_match_on"]] if isinstance(cfg["_match_on"], str) else cfg["_match_on"]
                got = codes.expand_partial(got, parts, on)
            if got is not None:
                frames.append(got)
    if not frames:
        return events.sparkSession.createDataFrame([], "code string")
    new = codes.reduce_codes(frames, options.description_separator, options.code_modifiers)
    return new if existing is None else codes.merge_existing(existing, new, ["code", *(options.code_modifiers or [])])


@dataclass
class Context:
    """What stages share: where things are, and the tables made so far by name."""

    spark: SparkSession
    spec: Spec
    spec_text: str
    input_dir: str
    output_dir: str
    options: Options
    tables: dict[str, DataFrame] = field(default_factory=dict)
    #: Subjects and events by split, as counted when they were written.
    subjects: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)

    @property
    def data(self) -> str:
        return f"{self.output_dir}/data"

    @property
    def metadata(self) -> str:
        return f"{self.output_dir}/metadata"

    def raw(self, name: str) -> DataFrame:
        return self.tables[f"raw/{name}"]


Stage = Callable[[Context], None]
#: Stages by name, in their usual order; callers may register more.
STAGES: dict[str, Stage] = {}


def stage(name: str) -> Callable[[Stage], Stage]:
    """Register a stage: a function that reads and adds tables of a context, or writes them."""

    def add(f: Stage) -> Stage:
        if name in STAGES:
            raise ValueError(f"stage {name} is registered already")
        STAGES[name] = f
        return f

    return add


def stage_named(name: str) -> Stage:
    """A registered stage, or one that an installed package offers as entry point of group ``chronoweave.stages``."""
    if name not in STAGES:
        for point in entry_points(group="chronoweave.stages", name=name):
            STAGES[name] = point.load()
    if name not in STAGES:
        raise KeyError(f"no stage {name}; there are {', '.join(STAGES)}")
    return STAGES[name]


@stage("raw_tables")
def raw_tables(c: Context) -> None:
    """Find and check the raw tables; only needed columns go on, with each row's position. CSV tables are scanned once and kept as Parquet."""
    need, storage = required_columns(c.spec), c.options.storage
    found = readers.find_data(c.spark, c.input_dir, list(need), storage)
    if missing := sorted(set(need) - set(found)):
        raise FileNotFoundError(f"no data files of {', '.join(missing)} below {c.input_dir}")
    for name, path in found.items():
        df = readers.read_table(c.spark, path, columns=need[name], position=cohort.ROW, storage=storage)
        c.tables[f"raw/{name}"] = readers.require(df, need[name], name, path, storage).select(*[F.col(f"`{x}`") for x in need[name]], cohort.ROW)


@stage("subjects")
def split_subjects(c: Context) -> None:
    """Assign all subjects to splits and shards; what splits share is reported."""
    shards = materialize(shards_of(c.spark, subjects_of(c.spec, c.raw), c.options), "shards")
    c.subjects = {r["split"]: r["n"] for r in shards.groupBy("split").agg(F.countDistinct("subject_id").alias("n")).orderBy("split").collect()}  # one row a split
    for split, n in c.subjects.items():
        log.info("split %s has %d subjects", split, n)
    for r in subjects.overlaps(shards).collect() if c.options.external_splits_json_fp else []:  # one row a pair of splits
        log.warning("splits %s and %s share %d subjects", r["a"], r["b"], r["n"])
    c.tables["shards"] = shards


@stage("cohort")
def write_events(c: Context) -> None:
    """All events, routed, distinct, in order; written, and counted by split as they are."""
    made = cohort_of(events_of(c.spec, c.raw, c.options), c.tables["shards"].drop("place"), c.options)
    seen, splits = Observation(), list(c.subjects)
    counted = made.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("split") == s).alias(f"n{i}") for i, s in enumerate(splits)])
    cohort.write_cohort(counted, c.data, named=c.options.layout == "shards", storage=c.options.storage)
    c.rows = {s: seen.get[f"n{i}"] for i, s in enumerate(splits)}
    for split, n in c.rows.items():
        log.info("split %s has %d events", split, n)
    c.tables["events"] = cohort.read_cohort(c.spark, c.data, c.options.storage)


@stage("codes")
def describe_codes(c: Context) -> None:
    """The code dictionary, from the events as written, joined to the one that is there."""
    storage = c.options.storage
    given = [c.options.existing_codes_fp] if c.options.existing_codes_fp else [f"{c.input_dir}/metadata/codes.parquet", f"{c.input_dir}/codes.parquet"]
    there = next((p for p in given if files.exists(c.spark, p, storage)), None)
    if c.options.existing_codes_fp and there is None:
        raise FileNotFoundError(f"there is no {c.options.existing_codes_fp}")
    existing = readers.read_table(c.spark, there, storage=storage) if there else None

    def metadata(name: str) -> DataFrame:
        return readers.read_metadata(c.spark, readers.find_metadata(c.spark, c.input_dir, name, storage), storage)

    found = codes_of(c.spec, metadata, c.tables["events"], c.options, existing)
    c.tables["codes"] = align.align_codes(c.spark.createDataFrame([], "code string") if found is None else found)


@stage("metadata")
def write_metadata(c: Context) -> None:
    """Codes, splits, description, shard map and the specification as it was."""
    shards = c.tables["shards"]
    finish_metadata(c.tables["codes"], shards, c.metadata, "errorifexists", c.options, {"subjects_by_split": c.subjects, "rows_by_split": c.rows})
    if c.options.split_by == "draw":
        # a shard's ids, at most n_subjects_per_shard, are one line
        subjects.write_lists(shards, f"{c.metadata}/.shards.json", c.options.storage)
    files.write_text(c.spark, f"{c.metadata}/spec.yaml", c.spec_text, c.options.storage)


#: What a run publishes.
FOLDERS = ("data", "metadata")
MANIFEST = ".manifest.json"
OUTPUTS = ("data", *[f"metadata/{n}" for n in ("codes.parquet", "subject_splits.parquet", "dataset.json", ".shards.json", "spec.yaml", MANIFEST)])


def run(spark: SparkSession, spec_path: str, input_dir: str, output_dir: str, options: Options | None = None, stages: list[str] | None = None) -> dict[str, str]:
    """Read the raw files, write ``data``, ``metadata/codes.parquet``, ``metadata/subject_splits.parquet``, ``metadata/dataset.json``
    and the shard map below ``output_dir``; FileExistsError if any of them is there and may not be overwritten. All paths may lie on
    any storage that Spark reaches. ``stages``: names of registered stages, instead of all in order.

    All or nothing: stages write to a hidden folder, which takes the old one's place when all are done; the manifest, a list of all files, is
    put in last. A run that fails leaves what was there.
    """
    options, output_dir = options or Options(), str(output_dir).rstrip("/")
    text = files.read_text(spark, spec_path, options.storage)
    if not options.do_overwrite and (there := [o for o in OUTPUTS if files.exists(spark, f"{output_dir}/{o}", options.storage)]):
        raise FileExistsError(f"{', '.join(there)} exist below {output_dir}; set do_overwrite to replace them")
    staging = f"{output_dir}/.staging-{uuid.uuid4().hex}"
    c = Context(spark, from_dict(yaml.safe_load(text)), text, str(input_dir), staging, options)
    try:
        with files.scratch():
            for run_stage in [stage_named(name) for name in stages or list(STAGES)]:
                run_stage(c)
        publish(spark, staging, output_dir, options.storage)
    finally:
        files.delete(spark, staging, options.storage)
    return {name: f"{output_dir}/{name}" for name in FOLDERS}


def publish(spark: SparkSession, staging: str, output_dir: str, storage: dict[str, str] | None = None) -> None:
    """Move finished folders to where they belong, old ones aside until all are moved; back again if one cannot be."""
    made = [name for name in FOLDERS if files.exists(spark, f"{staging}/{name}", storage)]
    listed = sorted(f"{name}/{f}" for name in made for f in files.walk(spark, f"{staging}/{name}", storage=storage))
    aside, moved = f"{staging}/.old", []
    try:
        for name in made:
            if files.exists(spark, f"{output_dir}/{name}", storage):
                files.move(spark, f"{output_dir}/{name}", f"{aside}/{name}", storage)
            moved.append(name)
            files.move(spark, f"{staging}/{name}", f"{output_dir}/{name}", storage)
        if "metadata" in made:
            files.write_text(spark, f"{output_dir}/metadata/{MANIFEST}", json.dumps({"files": listed}, indent=2), storage)
    except BaseException:
        for name in moved:
            files.delete(spark, f"{output_dir}/{name}", storage)
            if files.exists(spark, f"{aside}/{name}", storage):
                files.move(spark, f"{aside}/{name}", f"{output_dir}/{name}", storage)
        raise


def finish_metadata(code_rows: DataFrame, shards: DataFrame, meta_dir, mode: str, options: Options, counts: dict | None = None) -> None:
    """Codes, splits and the dataset's description, with what was counted on the way; the folder must be named metadata."""
    if str(meta_dir).rstrip("/").rpartition("/")[2] != "metadata":
        raise ValueError(f"the metadata folder must be named metadata, not {meta_dir}")
    code_rows.coalesce(1).write.options(**options.storage).mode(mode).parquet(f"{meta_dir}/codes.parquet")
    align.align(shards.select("subject_id", "split").distinct(), align.SPLITS).write.options(**options.storage).mode(mode).parquet(f"{meta_dir}/subject_splits.parquet")
    about = {"dataset_name": options.dataset_name, "dataset_version": options.dataset_version, "etl_name": "chronoweave", "etl_version": "1", "created_at": datetime.datetime.now(datetime.UTC).isoformat(), **(counts or {})}
    files.write_text(code_rows.sparkSession, f"{meta_dir}/dataset.json", json.dumps(about, indent=2), options.storage)
