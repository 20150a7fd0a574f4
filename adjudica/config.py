"""Settings: defaults, deep merge with a JSON document, dotted overrides; unknown keys are errors."""

from __future__ import annotations

import copy
import json
from typing import Any

#: Fixed values of the adjudication rules; all can be overridden.
DEFAULTS: dict[str, Any] = {
    "target_labels": ["pneumothorax"],
    "reference": {"margin_mm": 10.0, "required_kinds": ["lung", "thorax", "mediastinum"], "drop_path_components": [0, 2, 5, 6]},
    "tiny": {"annotation_mm2": 20.0, "stray_mm2": 20.0, "stray_ratio": 0.01},
    "small": {"by_class": {"focal": 20.0, "localized": 50.0, "regional": 150.0}, "band_factor": 3.0},
    "duplicate": {"iou_near": 0.95, "containment": 0.98},
    "outside_body": {"error": 0.80, "warn": 0.98, "min_mm2": 100.0},
    "mask": {"full_ratio": 0.95, "inverted_ratio": 0.5, "expected_values": [0, 255]},
    "divergence": {"negligible_ratio": 0.001},
    "policy": {
        "auto": ["D01_EXACT_DUPLICATE", "D05_CROSS_DATASET_DUPLICATE", "M01_MASK_RESOLUTION", "M02_MASK_CHANNELS", "M03_MASK_BINARY", "M04_MASK_NOT_EMPTY", "M05_FILE_EXISTS"],
        "review": [
            "D02_EXACT_MASK_LABEL_CONFLICT", "D03_NEAR_DUPLICATE", "D04_CONTAINED_DUPLICATE", "D05_CROSS_DATASET_DUPLICATE_TIE", "D05_CROSS_DATASET_MISMATCH",
            "S03_TINY_ANNOTATION", "S03_STRAY_COMPONENT", "S03_SUSPICIOUSLY_SMALL", "S04_ORIGINAL_FINAL_DIVERGENCE", "S05_OUTSIDE_BODY",
            "M07_BBOX_DEGENERATE", "M07_BBOX_OUT_OF_IMAGE", "M09_UNANNOTATED_VIEW",
        ],
        "informational": ["M06_PATH_FORMAT", "M07_BBOX_GEOMETRY", "M08_JSON_MASK_CONSISTENCY", "M07_SIZE_FIELDS_NULL"],
    },
    "cannot_determine_as_review_required": False,
    "review_image_classes": ["unannotated_view"],
    "finding_code_systems": ["Findings"],
    "normal_evidence": [["No Findings", "normal"]],
    "report_statuses": ["present", "absent"],
    "session_seconds": 600,
    "near_image": {"correlation": 0.98, "thumb": 32, "hash_side": 8},
}


def merged(base: dict, over: dict, at: str = "") -> dict:
    """base with the values of over; maps merge key by key. A key that base lacks is an error, but inside open maps."""
    out = copy.deepcopy(base)
    for key, value in over.items():
        where = f"{at}.{key}" if at else key
        if key not in out and at not in ("small.by_class",):
            raise KeyError(f"unknown setting {where}")
        out[key] = merged(out[key], value, where) if isinstance(out.get(key), dict) and isinstance(value, dict) else copy.deepcopy(value)
    return out


def with_overrides(config: dict, pairs: list[str]) -> dict:
    """Applies settings like a.b=value; a value is JSON, or else the text itself."""
    for pair in pairs:
        path, _, text = pair.partition("=")
        try:
            value = json.loads(text)
        except ValueError:
            value = text
        over: Any = value
        for key in reversed(path.split(".")):
            over = {key: over}
        config = merged(config, over)
    return config


def load(path: str | None = None, pairs: list[str] = ()) -> dict:
    config = DEFAULTS
    if path:
        with open(path, encoding="utf-8") as f:
            config = merged(config, json.load(f))
    return with_overrides(config, list(pairs))
