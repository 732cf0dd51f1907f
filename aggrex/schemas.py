"""Fixed schemas of the data model (never inferred) and canonical names."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

DATA_POINT_COLUMNS = [
    "data_type", "dx_uid", "period", "org_unit", "category_option_combo",
    "attribute_option_combo", "rate_type", "domain_type", "value",
]
DATA_POINT = T.StructType([T.StructField(c, S) for c in DATA_POINT_COLUMNS])

# The six attributes a data value payload carries, in payload order.
PUSH_COLUMNS = ["dx_uid", "period", "org_unit", "category_option_combo",
                "attribute_option_combo", "value"]

DATA_VALUE = T.StructType([T.StructField(c, S) for c in [
    "dataElement", "period", "orgUnit", "categoryOptionCombo", "attributeOptionCombo", "value"]])

ANALYTICS = T.StructType([T.StructField(c, S) for c in ["dx", "pe", "ou", "co", "value"]])

ORG_UNIT = T.StructType([
    T.StructField("id", S), T.StructField("name", S), T.StructField("shortName", S),
    T.StructField("openingDate", S), T.StructField("closedDate", S),
    T.StructField("parent", T.StructType([T.StructField("id", S)])),
    T.StructField("level", T.IntegerType()), T.StructField("path", S),
    T.StructField("geometry", S),
])

DATASET = T.StructType([
    T.StructField("id", S), T.StructField("name", S),
    T.StructField("organisation_units", T.ArrayType(S)),
    T.StructField("data_elements", T.ArrayType(S)),
])

CATEGORY_COMBO = T.StructType([
    T.StructField("id", S), T.StructField("displayName", S),
    T.StructField("categoryOptionCombos", T.ArrayType(T.StructType([
        T.StructField("id", S), T.StructField("displayName", S)]))),
])

EXTRACT_ITEM = T.StructType([
    T.StructField("item_pos", T.IntegerType()),
    T.StructField("data_sets", T.ArrayType(S)),
    T.StructField("data_elements", T.ArrayType(S)),
    T.StructField("frequency", S),
    T.StructField("cat_combos", T.ArrayType(S)),
    T.StructField("cat_option_combos", T.ArrayType(S)),
])

RATE_ITEM = T.StructType([
    T.StructField("extract_uid", S), T.StructField("dataset_uid", S),
    T.StructField("metrics", T.ArrayType(S)), T.StructField("period_window", T.IntegerType()),
    T.StructField("period_frequency", S), T.StructField("period_start", S),
    T.StructField("period_end", S),
])

UID_MAPPING = T.StructType([T.StructField(c, S) for c in ["field", "old_uid", "new_uid"]])

RATE_MAPPING = T.StructType([T.StructField(c, S) for c in [
    "extract_id", "dx_uid", "rate_type", "uid", "cat_option_combo", "attr_option_combo"]])

COMPLETION = T.StructType([
    T.StructField("dataSet", S), T.StructField("period", S),
    T.StructField("organisationUnit", S), T.StructField("date", S),
    T.StructField("completed", T.BooleanType()),
])

# Data-type names. Canonical (second generation) names and the
# first-generation aliases accepted at ingest.
DATA_ELEMENT = "DATA_ELEMENT"
REPORTING_RATE = "REPORTING_RATE"
INDICATOR = "INDICATOR"
DATA_TYPE_ALIASES = {"DATAELEMENT": DATA_ELEMENT, "DATASET": REPORTING_RATE}

# Fixed value: domain tag.
AGGREGATED = "AGGREGATED"

# Data point classes.
VALID = "valid"
TO_DELETE = "to_delete"
INVALID = "invalid"
