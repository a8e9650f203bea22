"""Time formats: strptime directives as Java patterns, and what kind of value they describe. Values as text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Directive -> (kind, pattern letters fit for 1 or 2 digits, fixed-width letters).
DIRECTIVES = {
    "Y": ("date", "yyyy", "yyyy"),
    "y": ("date", "yy", "yy"),
    "m": ("date", "M", "MM"),
    "d": ("date", "d", "dd"),
    "b": ("date", "MMM", "MMM"),
    "B": ("date", "MMMM", "MMMM"),
    "j": ("date", "D", "DDD"),
    "H": ("time", "H", "HH"),
    "I": ("time", "h", "hh"),
    "M": ("time", "m", "mm"),
    "S": ("time", "s", "ss"),
    "f": ("time", "SSSSSS", "SSSSSS"),
    "p": ("time", "a", "a"),
}


def java_pattern(fmt: str) -> tuple[str, str]:
    """(pattern, kind) for a strptime format; kind: date, time or datetime.

    A directive beside another one without a separator has a fixed width; elsewhere one digit is enough.
    """
    parts = re.findall(r"%(.)|([^%]+)", fmt)
    out, kinds = [], set()
    for i, (letter, text) in enumerate(parts):
        if not letter:
            out.append("".join(f"'{t}'" if t[:1].isalpha() else t for t in re.findall(r"[A-Za-z]+|[^A-Za-z']+", text)))
            continue
        if letter not in DIRECTIVES:
            raise ValueError(f"time format {fmt!r}: directive %{letter} is not supported")
        kind, loose, fixed = DIRECTIVES[letter]
        kinds.add(kind)
        beside = any(parts[j][0] for j in (i - 1, i + 1) if 0 <= j < len(parts))
        out.append(fixed if beside else loose)
    if not kinds:
        raise ValueError(f"time format {fmt!r} has no directives")
    return "".join(out), "datetime" if len(kinds) == 2 else kinds.pop()


def as_text(c: Column) -> Column:
    """A value as text. Numbers with a fraction are written with the fewest digits that tell them apart, plainly from 1e-5 to below 1e16 (of 32
    bits: 1e13), as ``1.5e20`` beyond; the infinite ones as ``inf``."""
    s = c.cast("string")
    shape = "^(-?)([0-9])[.]([0-9]+)E(-?[0-9]+)$"
    sign, first, exponent = (F.regexp_extract(s, shape, i) for i in (1, 2, 4))
    rest = F.regexp_replace(F.regexp_extract(s, shape, 3), "^0$", "")
    digits, point = F.concat(first, rest), exponent.try_cast("int") + 1
    long = F.when(F.length(digits) <= point, F.concat(F.rpad(digits, point, F.lit("0")), F.lit(".0"))).otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.length(digits))))
    short = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    scientific = F.concat(first, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(F.lit("")), F.lit("e"), exponent)
    most = F.when(F.typeof(c) == "float", 13).otherwise(16)
    number = F.concat(sign, F.when((point > 0) & (point <= most), long).when((point > -5) & (point <= 0), short).otherwise(scientific))
    fraction = F.typeof(c).isin("double", "float")
    return F.when(fraction & s.contains("E"), number).when(fraction & s.contains("Inf"), F.replace(s, F.lit("Infinity"), F.lit("inf"))).otherwise(s)
