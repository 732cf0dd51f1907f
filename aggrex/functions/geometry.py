"""Organisation unit field expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields an org unit must have before it can be created.
REQUIRED_FIELDS = ["id", "name", "shortName", "openingDate", "parent_id"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# A JSON number.
NUMBER = r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"


def canonical_numbers(text: Column) -> Column:
    """JSON text of arrays of numbers with every number written as a double."""
    found = F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0))
    between = F.split(text, NUMBER, -1)
    # + 0.0 turns minus zero into zero.
    numbers = F.concat(F.transform(found, lambda x: (x.cast("double") + F.lit(0.0)).cast("string")),
                       F.array(F.lit("")))
    return F.array_join(F.zip_with(between, numbers, lambda a, b: F.concat(a, b)), "")


def canonical_geometry(g, keep: bool | Column = True) -> Column:
    """GeoJSON text -> ``type|coordinates`` with the coordinates in compact
    JSON and every number as a double, so key order, blanks and number formats
    (1, 1.0, 1e0) do not count as a change. NULL when there is no geometry or
    when the target cannot store geometry (``keep`` false)."""
    g = _c(g)
    t = F.get_json_object(g, "$.type")
    coords = canonical_numbers(F.get_json_object(g, "$.coordinates"))
    canon = F.when(g.isNotNull() & t.isNotNull(), F.concat(t, F.lit("|"), coords))
    keep_col = keep if isinstance(keep, Column) else F.lit(bool(keep))
    return F.when(keep_col, canon)


def geometry_struct(g) -> Column:
    """H11 for payloads: struct(type, coordinates) with the coordinates as a
    VARIANT, so ``to_json`` writes them back as JSON; NULL without geometry."""
    g = _c(g)
    t = F.get_json_object(g, "$.type")
    return F.when(t.isNotNull(), F.struct(t.alias("type"),
                                         F.parse_json(F.get_json_object(g, "$.coordinates")).alias("coordinates")))


def target_keeps_geometry(version: str) -> bool:
    """Geometry is stored by targets newer than 2.32 (numeric compare:
    2.100 > 2.32)."""
    parts = [int(p) for p in version.split(".")[:3] if p.isdigit()]
    return tuple(parts) > (2, 32)


def missing_org_unit_fields() -> Column:
    """Names of the required fields that are absent."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED_FIELDS]))


def org_unit_is_valid() -> Column:
    """Id, name, shortName, openingDate and parent all present."""
    ok = F.lit(True)
    for c in REQUIRED_FIELDS:
        ok = ok & F.col(c).isNotNull()
    return ok
