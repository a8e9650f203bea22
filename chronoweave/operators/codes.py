"""The code dictionary: descriptions and parents of codes, matched from metadata tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metadata_values import columns_of, compile_value
from ..plans.spec import Event
from ..sources.files import materialize
from .union import diagonal_union

log = logging.getLogger(__name__)

MANDATORY = {"description": T.StringType(), "parent_codes": T.ArrayType(T.StringType())}


def _mandatory(df: DataFrame) -> DataFrame:
    out = df
    if "description" in df.columns:
        out = out.withColumn("description", F.col("description").cast("string"))
    if "parent_codes" in df.columns and not isinstance(df.schema["parent_codes"].dataType, T.ArrayType):
        out = out.withColumn("parent_codes", F.when(F.col("parent_codes").isNotNull(), F.array(F.col("parent_codes").cast("string"))))
    return out


def code_metadata(meta: DataFrame, event: Event, cfg: dict, observed: DataFrame | None = None) -> DataFrame:
    """What one metadata table says about one block's codes.

    Full match: the code expression is evaluated on the metadata rows, after the output columns, which it sees in place of source
    columns of the same name; rows of unobserved codes go (none, if nothing was observed). With ``_match_on`` the result holds
    the match columns instead of a code, for ``expand_partial``. Rows whose outputs are all null go.
    """
    cfg = dict(cfg)
    match_on = cfg.pop("_match_on", None)
    match_on = [match_on] if isinstance(match_on, str) else match_on
    if not cfg:
        raise KeyError(f"{event.source_block}: _metadata names no output columns")
    own = event.code.columns
    if match_on and (odd := [c for c in match_on if c not in own]):
        raise KeyError(f"{event.source_block}: _match_on columns {', '.join(odd)} are not in the code")
    need = set().union(*map(columns_of, cfg.values())) | set(match_on or own - set(cfg))
    if missing := sorted(need - set(meta.columns)):
        raise KeyError(f"{event.source_block}: metadata lacks columns {', '.join(missing)}")
    keys = [c for c in (match_on or sorted(own)) if c not in cfg]
    out = meta.select(*[F.col(f"`{c}`") for c in keys], *[compile_value(v).alias(k) for k, v in cfg.items()])
    kept = None
    for k in cfg:
        test = F.col(f"`{k}`").isNotNull()
        kept = test if kept is None else kept | test
    out = _mandatory(out.where(kept)).withColumn("code_template", F.lit(event.code_text))
    if match_on:
        return out.select(*match_on, *[k for k in cfg if k not in match_on], "code_template").dropDuplicates()
    out = out.withColumn("code", event.code.compile().cast("string")).select("code", *cfg, "code_template").where(F.col("code").isNotNull())
    if observed is not None and not observed.isEmpty():
        out = out.join(observed.select("code").distinct(), "code", "left_semi")
    return out.dropDuplicates()


def component_map(events: DataFrame) -> DataFrame | None:
    """Distinct (code, its component columns); None if no event has components."""
    if "code_components" not in events.columns:
        return None
    pairs = events.where(F.col("code_components").isNotNull()).select("code", "code_components").distinct()
    return pairs.select("code", "code_components.*")


def expand_partial(parts: DataFrame, components: DataFrame | None, match_on: list[str]) -> DataFrame | None:
    """Partial metadata joined to every code with the same components; None (nothing) without components."""
    if components is None or any(c not in components.columns for c in match_on):
        log.warning("no event has the code components %s: metadata matched on them is left out", ", ".join(match_on))
        return None
    outputs = [c for c in parts.columns if c not in match_on]
    keys = components.select("code", *[F.col(f"`{c}`").cast("string").alias(c) for c in match_on])
    side = parts.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in match_on], *outputs, *[F.col(f"`{c}`").alias(f"__out_{c}") for c in match_on])
    return keys.join(side, match_on).select("code", *outputs).dropDuplicates()


def reduce_codes(frames: list[DataFrame], separator: str = "\n", modifiers: list[str] | None = None) -> DataFrame:
    """One row a code. Only if some code repeats, all columns change shape: descriptions are joined by the separator, parents put
    together, the first template kept, other columns become lists (nulls included). Order: frame, then values.

    Whether a code repeats decides the result's schema, so the rows are written once and read for both.
    """
    keys = ["code", *(modifiers or [])]
    rows = diagonal_union([f.withColumn("__ord__", F.lit(i)) for i, f in enumerate(frames)])
    data = [c for c in rows.columns if c != "__ord__"]
    rows = materialize(rows.groupBy(*data).agg(F.min("__ord__").alias("__ord__")), "codes")
    if rows.groupBy(*keys).count().where("count > 1").isEmpty():
        return rows.drop("__ord__")
    others = [c for c in data if c not in keys]
    held = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__ord__", *others))).alias("__rows__"))
    out = [F.col(k) for k in keys]
    for c in others:
        values = F.col("__rows__").getField(c)
        if c == "description":
            present = F.filter(values, lambda v: v.isNotNull())
            out.append(F.when(F.size(present) > 0, F.array_join(present, separator)).alias(c))
        elif c == "parent_codes":
            out.append(F.flatten(F.filter(values, lambda v: v.isNotNull())).alias(c))
        elif c == "code_template":
            out.append(F.element_at(values, 1).alias(c))
        else:
            out.append(values.alias(c))
    return held.select(*out)


def merge_existing(existing: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """FULL OUTER JOIN on the keys; columns of ``new`` that ``existing`` has get ``_right``."""
    keys = keys or ["code"]
    named = new.select(*keys, *[F.col(f"`{c}`").alias(f"{c}_right" if c in existing.columns else c) for c in new.columns if c not in keys])
    return existing.join(named, keys, "full")
