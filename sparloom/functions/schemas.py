"""Flat schemas written as text, usable without a session (so in workers and at import)."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def flat(text: str) -> T.StructType:
    """'name kind, name kind' with simple kinds and map<string;string>."""
    fields = []
    for part in text.split(","):
        name, kind = part.split()
        made = T.MapType(T.StringType(), T.StringType()) if kind == "map<string;string>" else _KINDS[kind]
        fields.append(T.StructField(name, made))
    return T.StructType(fields)


def names(text: str) -> list[str]:
    return [part.split()[0] for part in text.split(",")]
