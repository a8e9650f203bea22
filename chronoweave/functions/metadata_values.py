"""Values of the code dictionary, read from metadata rows; here a bare string is a column.

``"col"``; ``["a", "b"]``: the first that is not null; ``{"out": {"col": "v"}}``: ``out`` where the column has the value;
``"LOINC/{loinc}"``: text with values; ``{"matcher": {...}, "output": ...}``: a condition written out, ``{"literal": "x"}`` a literal.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def columns_of(value) -> set[str]:
    """Columns that a value reads."""
    if isinstance(value, str):
        return set(re.findall(r"\{(\w+)\}", value)) or {value}
    if isinstance(value, list):
        return set().union(*map(columns_of, value))
    if "literal" in value and len(value) == 1:
        return set()
    if "matcher" in value:
        return set(value["matcher"]) | columns_of(value["output"])
    return set().union(*({*cond} | columns_of(out) for out, cond in value.items()))


def compile_value(value) -> Column:
    """The value as a Column over metadata rows."""
    if isinstance(value, str):
        if "{" not in value:
            return F.col(f"`{value}`")
        pieces = re.split(r"\{(\w+)\}", value)
        return F.concat(*[F.col(f"`{p}`").cast("string") if i % 2 else F.lit(p) for i, p in enumerate(pieces) if i % 2 or p])
    if isinstance(value, list):
        return F.coalesce(*map(compile_value, value))
    if not isinstance(value, dict):
        raise TypeError(f"metadata value {value!r} must be a string, list or mapping")
    if "literal" in value and len(value) == 1:
        return F.lit(value["literal"])
    cases = [(value["output"], value["matcher"])] if "matcher" in value else list(value.items())
    if any(not isinstance(cond, dict) for _, cond in cases):
        raise TypeError(f"metadata value {value!r}: a condition must be a mapping of columns to values")
    whens = [F.when(reduce(lambda a, b: a & b, [F.col(f"`{c}`").cast("string") == str(v) for c, v in cond.items()]), compile_value(out)) for out, cond in cases]
    return F.coalesce(*whens)
