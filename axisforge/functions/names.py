"""Names that paths carry, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Endings of the names of file lists that aren't part of a dataset's name.
LIST_ENDINGS = ("_filelist", "_files", "_file_list")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The basename less its last extension; a leading dot starts no extension."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def list_label(path: Column) -> Column:
    """The dataset that a list of files is for: its stem less the first fitting one of LIST_ENDINGS."""
    s, out = stem(path), None
    for ending in LIST_ENDINGS:
        cut = F.substring(s, F.lit(1), F.length(s) - len(ending))
        out = F.when(s.endswith(ending), cut) if out is None else out.when(s.endswith(ending), cut)
    return out.otherwise(s)


def label_before(path: Column, marker: str) -> Column:
    """The last name of a folder's path up to the marker; the whole name without one."""
    name = basename(F.regexp_replace(path, "/+$", ""))
    return F.substring_index(name, marker, 1) if marker else name


def strip_redirector(path: Column, scheme: str = "root") -> Column:
    return F.regexp_replace(path, rf"^{scheme}://[^/]+/+", "/")


def with_redirector(path: Column, redirector: str) -> Column:
    return F.concat(F.lit(redirector), F.lit("/"), F.ltrim(path, F.lit("/")))


def mixed_name(path: Column, tag: str = "") -> Column:
    return F.concat(F.lit(f"mixed_{tag}_" if tag else "mixed_"), basename(path))
