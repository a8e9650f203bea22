"""The value expressions of a specification, compiled to Columns.

=============================  =======================================================
``$name``                      column
``word``, ``"text"``, ``3.5``  literal
``f"A//{$x}//{$y}"``           text with values; null if one of them is
``e as "%Y-%m-%d"``, ``::``    strict time parsing: what does not fit is an error
``e as ?"%Y"``, ``::?``        lenient time parsing: what does not fit is null
``e::str`` (int, float, bool)  cast
``+ - * /``                    arithmetic; ``*`` and ``/`` bind closer
``hash(e)``                    64-bit hash, null for null
``set_time(date, time)``       date and time of day combined; also ``date @ time``
=============================  =======================================================

Casts bind closest, then ``*``, ``+``, ``@``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .formats import as_text, java_pattern

CASTS = {"str": "string", "int": "bigint", "float": "double", "bool": "boolean"}

_TOKEN = re.compile(
    r"""\s*(?:(?P<col>\$[A-Za-z_]\w*(?:\.\w+)*)|(?P<f>f"(?:[^"\\]|\\.)*"|f'(?:[^'\\]|\\.)*')|(?P<text>"[^"]*"|'[^']*')
    |(?P<num>\d+(?:\.\d+)?)|(?P<word>[A-Za-z_]\w*(?://\w+)*)|(?P<op>::|[-+*/@(),?]))""",
    re.X,
)


@dataclass(frozen=True)
class Expr:
    """A parsed expression. kind: column, literal, text, time, cast, arith, hash or combine."""

    kind: str
    value: object = None
    args: tuple[Expr, ...] = ()

    @property
    def columns(self) -> set[str]:
        """Names of the columns it reads."""
        own = {self.value} if self.kind == "column" else set()
        return own.union(*(a.columns for a in self.args))

    def compile(self) -> Column:
        a = [x.compile() for x in self.args]
        match self.kind:
            case "column":
                return F.col(f"`{self.value}`")
            case "literal":
                return F.lit(self.value)
            case "text":
                return F.concat(*[as_text(x) for x in a])
            case "cast":
                return as_text(a[0]) if self.value == "string" else a[0].cast(self.value)
            case "arith":
                return {"+": a[0] + a[1], "-": a[0] - a[1], "*": a[0] * a[1], "/": a[0] / a[1]}[self.value]
            case "hash":
                return F.when(a[0].isNotNull(), F.xxhash64(a[0]))
            case "combine":
                midnight = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
                return a[0].cast("date").cast("timestamp_ntz") + (a[1].cast("timestamp_ntz") - midnight)
        fmt, strict = self.value
        pattern, kind = java_pattern(fmt)
        parsed = F.try_to_timestamp(a[0].cast("string"), F.lit(pattern)).cast("timestamp_ntz")
        if strict:
            wrong = F.raise_error(F.concat(F.lit(f"does not fit time format {fmt!r}: "), a[0].cast("string"))).cast("timestamp_ntz")
            parsed = F.when(a[0].isNotNull() & parsed.isNull(), wrong).otherwise(parsed)
        return parsed.cast("date") if kind == "date" else parsed


def parse(source: str) -> Expr:
    """The expression that ``source`` writes; ValueError if it is none."""
    tokens, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise ValueError(f"cannot read expression {source!r} from {source[at:]!r} on")
        tokens.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    place = 0

    def peek() -> tuple[str, str]:
        return tokens[place] if place < len(tokens) else ("end", "")

    def take(*wanted: str) -> tuple[str, str]:
        nonlocal place
        kind, text = peek()
        if wanted and text not in wanted and kind not in wanted:
            raise ValueError(f"expression {source!r}: {' or '.join(wanted)} expected before {text or 'the end'!r}")
        place += 1
        return kind, text

    def chain(ops: str, below):
        left = below()
        while peek()[0] == "op" and peek()[1] in ops:
            op = take()[1]
            right = below()
            left = Expr("combine", None, (left, right)) if op == "@" else Expr("arith", op, (left, right))
        return left

    def combined() -> Expr:
        return chain("@", lambda: chain("+-", lambda: chain("*/", converted)))

    def converted() -> Expr:
        e = atom()
        while peek() in (("op", "::"), ("word", "as")):
            take()
            lenient = peek() == ("op", "?")
            if lenient:
                take()
            kind, text = take("text", "word")
            if kind == "text":
                e = Expr("time", (text[1:-1], not lenient), (e,))
            elif text in CASTS:
                e = Expr("cast", CASTS[text], (e,))
            else:
                raise ValueError(f"expression {source!r}: unknown type {text!r}")
        return e

    def atom() -> Expr:
        kind, text = take("col", "f", "text", "num", "word", "(", "-")
        if kind == "col":
            return Expr("column", text[1:])
        if kind == "text":
            return Expr("literal", text[1:-1])
        if kind == "num":
            return Expr("literal", float(text) if "." in text else int(text))
        if kind == "f":
            return interpolated(text[2:-1])
        if text == "-":
            return Expr("arith", "-", (Expr("literal", 0), atom()))
        if text == "(":
            e = combined()
            take(")")
            return e
        if peek() != ("op", "("):
            return Expr("literal", text)
        take()
        args = [combined()]
        while peek() == ("op", ","):
            take()
            args.append(combined())
        take(")")
        if text == "hash" and len(args) == 1:
            return Expr("hash", None, tuple(args))
        if text == "set_time" and len(args) == 2:
            return Expr("combine", None, tuple(args))
        raise ValueError(f"expression {source!r}: no function {text} of {len(args)} arguments")

    def interpolated(text: str) -> Expr:
        pieces = re.split(r"\{([^{}]*)\}", text)
        args = [parse(p) if i % 2 else Expr("literal", p) for i, p in enumerate(pieces) if i % 2 or p]
        return Expr("text", None, tuple(args)) if args else Expr("literal", "")

    e = combined()
    take("end")
    return e
