"""Collections of physics objects in either of two layouts: one array of records, or one array for each field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Collections that are regrouped from flat fields, and the fields that a jet must have.
COLLECTIONS = ("ScoutingPFJet", "GenJet", "GenPart")
JET_FIELDS = ("pt", "eta", "phi", "m")


def jet_format(df: DataFrame, branch: str = COLLECTIONS[0]) -> str | None:
    """nested (an array of records with pt), flat (arrays <branch>_pt, ...) or None; nested if both."""
    for f in df.schema.fields:
        if f.name == branch and isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType) and "pt" in f.dataType.elementType.names:
            return "nested"
    return "flat" if f"{branch}_pt" in df.columns else None


def _records(records: Column, fields: dict[str, str]) -> Column:
    """Records with the given fields, renamed."""
    return F.transform(records, lambda x: F.struct(*[x[c].alias(n) for c, n in fields.items()]))


def to_nested(df: DataFrame, collections: tuple[str, ...] = COLLECTIONS) -> DataFrame:
    """df with the flat fields of collections as arrays of records; their counters (n<branch>) go with them.

    All other columns pass through. Every column that starts with a collection's name and an
    underscore is taken for a field of it.
    """
    flat = {b: [c for c in df.columns if c.startswith(f"{b}_")] for b in collections}
    gone = {c for cs in flat.values() for c in cs} | {f"n{b}" for b, cs in flat.items() if cs} | {b for b, cs in flat.items() if cs}
    rest = [F.col(f"`{c}`") for c in df.columns if c not in gone]
    grouped = []
    for b, cs in flat.items():
        if cs:
            names = [c[len(b) + 1 :] for c in cs]
            grouped.append(_records(F.arrays_zip(*[F.col(f"`{c}`") for c in cs]), dict(zip(cs, names, strict=True))).alias(b))
    return df.select(*rest, *grouped)


def to_flat(df: DataFrame, branch: str = COLLECTIONS[0], fields: tuple[str, ...] = JET_FIELDS) -> DataFrame:
    """df with the records of a collection as one array for each field, and their number in n<branch>."""
    own = [F.col(branch)[f].alias(f"{branch}_{f}") for f in fields]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != branch], F.size(branch).alias(f"n{branch}"), *own)


def with_jets(df: DataFrame, branch: str = COLLECTIONS[0], name: str = "jets") -> DataFrame:
    """df with the jets' pt, eta, phi and m as doubles in `name`, from either layout."""
    layout = jet_format(df, branch)
    if layout is None:
        raise ValueError(f"no jets: neither {branch} with pt nor {branch}_pt among {sorted(df.columns)}")
    if layout == "nested":
        jets = F.transform(branch, lambda x: F.struct(*[x[f].cast("double").alias(f) for f in JET_FIELDS]))
    else:
        jets = F.transform(F.arrays_zip(*[f"{branch}_{f}" for f in JET_FIELDS]), lambda x: F.struct(*[x[f"{branch}_{f}"].cast("double").alias(f) for f in JET_FIELDS]))
    return df.withColumn(name, jets)
