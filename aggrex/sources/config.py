"""JSON configuration -> small typed dimensions.

Configuration is the one thing read on the driver: it is a few kilobytes of
JSON. Everything it becomes is a DataFrame (broadcast, size known).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from aggrex.operators.dims import config_dim
from aggrex.schemas import EXTRACT_ITEM, RATE_ITEM, RATE_MAPPING, UID_MAPPING

# Configuration sections of the mapping file and the data point
# field each one maps.
MAPPING_SECTIONS = {"CAT_OPTION_COMBOS": "category_option_combo",
                    "ATTR_OPTION_COMBOS": "attribute_option_combo"}


# Accepted import strategies.
IMPORT_STRATEGIES = ["CREATE", "UPDATE", "CREATE_AND_UPDATE"]


def validate_push_settings(settings: dict, default_max_post: int = 500) -> dict:
    """Check the push settings before anything is sent: a known import
    strategy, a positive batch size, a boolean dry-run flag (dry run by
    default). Returns the settings with defaults filled in."""
    out = {"IMPORT_STRATEGY": "CREATE_AND_UPDATE", "DRY_RUN": True, "MAX_POST": default_max_post}
    out.update({k: v for k, v in settings.items() if v is not None})
    if out["IMPORT_STRATEGY"] not in IMPORT_STRATEGIES:
        raise ValueError(f"invalid import strategy {out['IMPORT_STRATEGY']!r}; use one of {IMPORT_STRATEGIES}")
    if not isinstance(out["MAX_POST"], int) or isinstance(out["MAX_POST"], bool) or out["MAX_POST"] < 1:
        raise ValueError(f"MAX_POST must be a positive integer, got {out['MAX_POST']!r}")
    if not isinstance(out["DRY_RUN"], bool):
        raise ValueError(f"DRY_RUN must be true or false, got {out['DRY_RUN']!r}")
    return out


def load_configuration(path_or_text: str) -> dict:
    """Parse a configuration file (or its text)."""
    text = path_or_text
    if not path_or_text.lstrip().startswith("{"):
        with open(path_or_text, encoding="utf-8") as fh:
            text = fh.read()
    return json.loads(text)


def rate_extracts(config: dict) -> list[dict]:
    """Second-generation rate extracts: ``REPORTING_RATES.EXTRACTS``."""
    section = config.get("REPORTING_RATES") or {}
    return list(section.get("EXTRACTS") or []) if isinstance(section, dict) else []


def uid_mapping_rows(config: dict) -> tuple[list[tuple], dict[str, str]]:
    """DATA_ELEMENT_MAPPINGS -> (field, old_uid, new_uid) rows and defaults."""
    m = config.get("DATA_ELEMENT_MAPPINGS", {}) or {}
    rows = [("dx_uid", k, v) for k, v in (m.get("UIDS") or {}).items()]
    defaults = {}
    for section, field in MAPPING_SECTIONS.items():
        sec = m.get(section) or {}
        rows += [(field, k, v) for k, v in (sec.get("UIDS") or {}).items()]
        if sec.get("DEFAULT"):
            defaults[field] = sec["DEFAULT"]
    return rows, defaults


def rate_mapping_rows(config: dict) -> list[tuple]:
    """Rate mappings of either generation -> RATE_MAPPING rows.

    First generation: RATE_MAPPINGS {dataset: {RATE_TYPE, UID, CAT_OPTION_COMBO,
    ATTR_OPTION_COMBO}} (extract_id NULL). Second generation: per extract
    MAPPINGS {dataset: {metric: {UID, CAT_OPTION_COMBO, ATTR_OPTION_COMBO}}}.
    """
    rows = []
    for ds, m in (config.get("RATE_MAPPINGS") or {}).items():
        rows.append((None, ds, m.get("RATE_TYPE"), m.get("UID"), m.get("CAT_OPTION_COMBO"),
                     m.get("ATTR_OPTION_COMBO")))
    for ex in rate_extracts(config):
        for ds, metrics in (ex.get("MAPPINGS") or {}).items():
            for metric, m in metrics.items():
                rows.append((ex.get("EXTRACT_UID"), ds, metric, m.get("UID"), m.get("CAT_OPTION_COMBO"),
                             m.get("ATTR_OPTION_COMBO")))
    return rows


def extract_item_rows(config: dict) -> list[tuple]:
    """First-generation DATA_SETS list -> EXTRACT_ITEM rows (position kept)."""
    out = []
    for pos, item in enumerate(config.get("DATA_SETS") or []):
        out.append((pos, item.get("DATA_SETS") or [], item.get("DATA_ELEMENTS") or [], item.get("FREQUENCY"),
                    item.get("CAT_COMBOS") or [], item.get("CAT_OPTION_COMBOS") or []))
    return out


def rate_item_rows(config: dict) -> list[tuple]:
    """Rate extracts of either generation -> RATE_ITEM rows.

    First generation RATE_UIDS {dataset: {METRICS: {name: type} | [names],
    FREQUENCY}}; second generation a list of extracts."""
    out = []
    for ds, spec in (config.get("RATE_UIDS") or {}).items():
        metrics = spec.get("METRICS") or {}
        names = list(metrics.keys()) if isinstance(metrics, dict) else list(metrics)
        out.append((None, ds, names, None, spec.get("FREQUENCY"), None, None))
    for ex in rate_extracts(config):
        metrics = ex.get("METRICS") or []
        names = list(metrics.keys()) if isinstance(metrics, dict) else list(metrics)
        out.append((ex.get("EXTRACT_UID"), ex.get("DATASET_UID"), names, ex.get("PERIOD_WINDOW", 3),
                    ex.get("PERIOD_FREQUENCY"), ex.get("PERIOD_START"), ex.get("PERIOD_END")))
    return out


def config_dimensions(spark: SparkSession, config: dict) -> dict[str, DataFrame | dict]:
    """All dimensions of a configuration."""
    uid_rows, defaults = uid_mapping_rows(config)
    settings = {}
    for section in ("EXTRACT_SETTINGS", "PUSH_SETTINGS", "SETTINGS"):
        settings.update(config.get(section) or {})
    return {
        "settings": settings,
        "uid_mapping": config_dim(spark, uid_rows, UID_MAPPING),
        "uid_defaults": defaults,
        "rate_mapping": config_dim(spark, rate_mapping_rows(config), RATE_MAPPING),
        "extract_items": config_dim(spark, extract_item_rows(config), EXTRACT_ITEM),
        "rate_items": config_dim(spark, rate_item_rows(config), RATE_ITEM),
    }
