"""Column expressions that read values written in more than one way.

All stay inside the JVM.  NULL gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str.strip`` sees it, and zero-width marks; fixed values.
_WS = r"[\s\p{Z}\x{85}\x{200b}-\x{200d}\x{2060}\x{feff}]"
#: Class names and their labels; fixed values of the task.
CLASSES = {"0": "Recyclable", "1": "Electronic", "2": "Organic"}


def strip(c: Column) -> Column:
    """Without white space (Unicode's too) at either end."""
    return F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")


def is_blank(c: Column) -> Column:
    """NULL, empty or white space only."""
    return c.isNull() | F.regexp_like(c, F.lit(f"^{_WS}*$"))


def image_key(c: Column) -> Column:
    """What two spellings of one image path share: the last three parts of the path, decoded, in lower case.

    A path of fewer parts is kept whole.  Blank gives an empty string, NULL gives NULL.
    """
    plain = r"^[A-Za-z0-9][A-Za-z0-9_()~ -]*/[A-Za-z0-9][A-Za-z0-9_()~ -]*/[A-Za-z0-9](?:[A-Za-z0-9_.()~ -]*[A-Za-z0-9)])?\z"
    # each step uses the one before it once: a nested expression used twice doubles the generated code
    p = F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    p = F.regexp_replace(strip(F.lower(p)), r"[\\/]+(?:\.[\\/]+)*", "/")
    p = F.regexp_replace(p, r"^\./", "")
    p = F.regexp_replace(p, r"^(?s:.*)/([^/]+/[^/]+/[^/]+)$", "$1")
    return F.when(F.regexp_like(c, F.lit(plain)), F.lower(c)).otherwise(p)  # most paths are plain, and one test spares them the rest


def class_label(c: Column) -> Column:
    """``0``, ``1`` or ``2`` if the text denotes that class by number or name; else NULL."""
    t = F.lower(strip(c))
    for k, name in CLASSES.items():
        t = F.regexp_replace(t, f"^(?:0*{k}[ _-])?{name.lower()}$", k)
    t = F.regexp_replace(t, r"^\+?0*([012])(?:\.0*)?$", "$1")
    return F.try_element_at(F.create_map(*[F.lit(k) for k in CLASSES for _ in "ab"]), t)


def positive_number(c: Column) -> Column:
    """A positive, finite double from ``640``, ``640.0``, ``640px`` or ``1,024``; else NULL."""
    t = F.regexp_replace(strip(F.lower(c)), r"\s*px$", "")
    t = F.regexp_replace(t, r"(?<=\d),(?=\d{3}(?:\D|$))", "")
    v = F.regexp_extract(t, r"^\+?((?:\d+\.?\d*|\.\d+)(?:e[+-]?\d{1,2})?)$", 1).try_cast("double")
    return F.nullif(v, F.lit(0.0))


def whole_number(c: Column) -> Column:
    """A bigint from `` 12``, ``12`` or ``12.0``; else NULL."""
    return F.regexp_extract(strip(c), r"^\+?(\d{1,18})(?:\.0*)?$", 1).try_cast("bigint")


def flag(c: Column) -> Column:
    """True for 1, 1.0, true, yes; false for any other text and for NULL."""
    return F.coalesce(F.regexp_like(strip(F.lower(c)), F.lit(r"^(0*1(\.0*)?|true|t|yes|y)$")), F.lit(False))


def sha256_digest(c: Column) -> Column:
    """The 64 hex digits in lower case, without a ``sha256`` prefix; NULL unless the digest is whole."""
    return F.nullif(F.regexp_extract(strip(F.lower(c)), r"^(?:sha-?256\s*[:=-]?\s*)?([0-9a-f]{64})$", 1), F.lit(""))


def source_code(c: Column) -> Column:
    """A capture source (two letters, two digits) in lower case; NULL if the text names none."""
    t = F.regexp_extract(strip(F.lower(c)), r"^([a-z]{2}[ _.-]?\d{2})$", 1)
    return F.nullif(F.regexp_replace(t, r"[ _.-]", ""), F.lit(""))


def split_name(c: Column) -> Column:
    """train, val or test, from the file name of the manifest a record came from; else NULL."""
    return F.nullif(F.regexp_extract(strip(F.lower(c)), r"(?:^|[\\/])(train|val|test)_manifest\.[^\\/]*$", 1), F.lit(""))


def object_entity(c: Column) -> Column:
    """``xy12-345``: capture source and object number named by an image's file name; NULL if it names none.

    The name starts with the class letter; a copy mark may stand before it and a date after it.  The
    object's number is the first number after the source code.
    """
    named = r"^(?:.*[\\/])?(?:thumb_|copy of )*[a-z][_.-](?:\d{8}[_.-])?([a-z]{2}\d{2})[_.-]?(?:obj)?0*(\d+)[^\\/]*$"
    e = F.regexp_replace(F.lower(c), named, "$1-$2")
    return F.nullif(F.regexp_extract(e, r"^[a-z]{2}\d{2}-\d+$", 0), F.lit(""))


def cluster_name(c: Column) -> Column:
    """``C`` and two digits from ``C7``, ``c007``, ``cluster 7`` or ``7``; else NULL."""
    n = F.regexp_extract(strip(F.lower(c)), r"^(?:c|cluster)?[ _]?0*(\d{1,9})$", 1).try_cast("int")
    return F.when(n.isNotNull(), F.format_string("C%02d", n))
