"""Which type holds the values of two: the lattice by which stored tables widen.

``TINYINT < SMALLINT < INT < BIGINT < DOUBLE < STRING``, ``FLOAT < DOUBLE``, ``DATE < TIMESTAMP < STRING``; every other pair of
different simple types meets at STRING, and VOID (a column without any value) is below all. Nested types and BINARY only meet themselves.
BIGINT meets DOUBLE at DOUBLE only where every value survives (:data:`EXACT_IN_DOUBLE`); :func:`exactly_wider` looks at
the values and takes STRING otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Whole numbers up to this size, and all narrower ones, are doubles too.
EXACT_IN_DOUBLE = 2**53


def wider(a: str, b: str) -> str:
    """The least type that holds both (simple type strings)."""
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    if any(t.startswith(("array", "map", "struct", "binary")) for t in (a, b)):
        raise ValueError(f"{a} and {b} have no type in common")
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    numbers = (*WHOLE, "float", "double")
    if a in numbers and b in numbers:
        return "double"
    if {a, b} == {"date", "timestamp"}:
        return "timestamp"
    return "string"


def types_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def merged_types(stored: Mapping[str, str], incoming: Mapping[str, str]) -> dict[str, str]:
    """Columns of both: the stored ones in their order, then the new ones sorted by name. Names that differ only in case are refused."""
    by_name = {c.lower(): c for c in stored}
    for c in incoming:
        if by_name.get(c.lower(), c) != c:
            raise ValueError(f"column {c} differs only in case from {by_name[c.lower()]}")
    out = {c: wider(t, incoming[c]) if c in incoming else t for c, t in stored.items()}
    return out | {c: incoming[c] for c in sorted(incoming) if c not in stored}


def lossy_columns(types: Mapping[str, str], target: Mapping[str, str]) -> list[str]:
    """Columns whose BIGINT values would become DOUBLE ones."""
    return [c for c, t in types.items() if t == "bigint" and target.get(c) == "double"]


def exactly_wider(sides: list[tuple[DataFrame, Mapping[str, str]]], target: Mapping[str, str]) -> dict[str, str]:
    """``target`` with STRING for each column that would be DOUBLE although a whole number in one of ``sides`` has too many digits.

    One aggregate over the BIGINT columns in question, of the sides that have any.
    """
    out = dict(target)
    for df, types in sides:
        names = lossy_columns(types, out)
        if names:
            large = [F.coalesce(F.bool_or((F.col(f"`{c}`") > EXACT_IN_DOUBLE) | (F.col(f"`{c}`") < -EXACT_IN_DOUBLE)), F.lit(False)).alias(c) for c in names]
            found = df.agg(*large).first()
            out.update({c: "string" for c in names if found[c]})
    return out


def as_types(df: DataFrame, target: Mapping[str, str], prefix: str = "") -> list[Column]:
    """``df``'s columns as those of ``target``, by name; a column that it lacks is NULL."""
    have = set(df.columns)
    return [(F.col(f"`{prefix}{c}`") if prefix + c in have else F.lit(None)).cast(t).alias(c) for c, t in target.items()]
