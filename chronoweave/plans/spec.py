"""The specification: which rows of which tables become which events."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..functions.expr import Expr, parse

RESERVED = ("_metadata", "join", "transforms", "schema", "subject_id_expr", "subject_id_col")


@dataclass(frozen=True)
class Join:
    """A left lookup join before anything else is computed."""

    table: str
    left_on: str
    right_on: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Event:
    """One kind of event of a table."""

    table: str
    name: str
    code: Expr
    time: Expr | None
    extras: dict[str, Expr]
    metadata: dict[str, dict]
    code_text: str

    @property
    def source_block(self) -> str:
        return f"{self.table}/{self.name}"

    @property
    def columns(self) -> set[str]:
        return set().union(*(e.columns for e in (self.code, *([self.time] if self.time else []), *self.extras.values())))


@dataclass(frozen=True)
class Table:
    """A raw table and what is made of it."""

    name: str
    id_col: str
    id_expr: Expr | None
    join: Join | None
    transforms: dict[str, Expr]
    events: tuple[Event, ...]


@dataclass(frozen=True)
class Spec:
    tables: dict[str, Table] = field(default_factory=dict)

    @property
    def events(self) -> list[Event]:
        return [e for t in self.tables.values() for e in t.events]


def event(table: str, name: str, cfg: dict) -> Event:
    """A checked event block. KeyError: code or time missing; ValueError: a value that is no expression."""
    if not isinstance(cfg, dict):
        raise TypeError(f"event {table}/{name} must be a mapping")
    for key in ("code", "time"):
        if key not in cfg:
            raise KeyError(f"event {table}/{name} has no {key}")
    if cfg["code"] is None:
        raise ValueError(f"event {table}/{name}: code must not be null")
    extras = {k: v for k, v in cfg.items() if k not in ("code", "time", "_metadata")}
    for k, v in {"code": cfg["code"], **({"time": cfg["time"]} if cfg["time"] is not None else {}), **extras}.items():
        if not isinstance(v, str):
            raise ValueError(f"event {table}/{name}: {k} must be an expression in a string, not {v!r}")
    metadata = cfg.get("_metadata", {})
    if "_metadata" in cfg and not isinstance(metadata, dict):
        raise TypeError(f"event {table}/{name}: _metadata must be a mapping")
    if "_metadata" in cfg and not metadata:
        raise KeyError(f"event {table}/{name}: _metadata is empty")
    time = None if cfg["time"] is None else parse(cfg["time"])
    return Event(table, name, parse(cfg["code"]), time, {k: parse(v) for k, v in extras.items()}, metadata, cfg["code"].strip())


def from_dict(cfg: dict) -> Spec:
    """The specification from its parsed YAML."""
    default_id = cfg.get("subject_id_col", "subject_id")
    tables = {}
    for name, t in cfg.items():
        if name == "subject_id_col":
            continue
        t = t or {}
        if not isinstance(t, dict):
            raise TypeError(f"table {name} must be a mapping")
        join = None
        if j := t.get("join"):
            missing = [k for k in ("input_prefix", "left_on", "right_on", "columns_from_right") if k not in j]
            if missing:
                raise KeyError(f"table {name}: join lacks {', '.join(missing)}")
            join = Join(j["input_prefix"], j["left_on"], j["right_on"], tuple(j["columns_from_right"]))
        events = tuple(event(name, k, v) for k, v in t.items() if k not in RESERVED)
        tables[name] = Table(
            name,
            t.get("subject_id_col", default_id),
            parse(t["subject_id_expr"]) if t.get("subject_id_expr") else None,
            join,
            {k: parse(str(v)) for k, v in (t.get("transforms") or {}).items()},
            events,
        )
    return Spec(tables)


def required_columns(spec: Spec) -> dict[str, list[str]]:
    """Source columns of each raw table that the specification reads, for early checks; Catalyst prunes by itself.

    Columns that transforms define or a join brings are not source columns of the table itself.
    """
    need: dict[str, set[str]] = {}
    for t in spec.tables.values():
        own = need.setdefault(t.name, set())
        own |= t.id_expr.columns if t.id_expr else {t.id_col}
        for e in t.transforms.values():
            own |= e.columns
        for e in t.events:
            own |= e.columns - set(t.transforms)
        if t.join:
            own -= set(t.join.columns)
            own.add(t.join.left_on)
            need.setdefault(t.join.table, set()).update({t.join.right_on, *t.join.columns})
    return {k: sorted(v) for k, v in need.items()}
