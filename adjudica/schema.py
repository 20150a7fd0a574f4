"""Schemas of nested source documents and canonical tables."""

from __future__ import annotations

_LABELS = "ARRAY<STRUCT<label_id: BIGINT, code: STRING, code_system: STRING, code_text: STRING, code_text_eng: STRING, confidence: DOUBLE>>"
_CASE = f"ARRAY<STRUCT<annotation_id: BIGINT, labels: {_LABELS}>>"

#: A source document; keys of the outer maps are data, so nothing is inferred.
SOURCE_DDL = f"""
version_id STRING, version_date STRING,
dataset MAP<STRING, MAP<STRING, STRUCT<
  patient_id: STRING, study_name: STRING, study_date: STRING, annotations: {_CASE},
  report_labels: STRUCT<study_name: STRING, source_dataset_id: STRING, source_json: STRING, schema_version: INT, needs_review: BOOLEAN, flags: ARRAY<STRING>, finding_labels_observed: ARRAY<STRING>,
    pneumothorax_status: STRING, pneumothorax_side: STRING, pneumothorax_subtype: STRING, pneumothorax_evidence: STRING, pneumothorax_certainty_max: STRING,
    pneumothorax_certainty_counts: MAP<STRING, INT>, pneumothorax_absent_certainty_counts: MAP<STRING, INT>,
    bulla_bleb_status: STRING, bulla_bleb_evidence: STRING, bulla_bleb_certainty_max: STRING, bulla_bleb_certainty_counts: MAP<STRING, INT>,
    pleural_effusion_status: STRING, pleural_effusion_evidence: STRING, pleural_effusion_certainty_max: STRING, pleural_effusion_flags: ARRAY<STRING>>,
  series_list: MAP<STRING, STRUCT<
    spacing: STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE>, shape: STRUCT<w: INT, h: INT, z: INT>, manufacturer: STRING, annotations: {_CASE},
    file_list: MAP<STRING, STRUCT<
      dataset_id: STRING, image_path: STRING,
      annotations: ARRAY<STRUCT<annotation_type: STRING, geometry_id: BIGINT, geometry_uid: STRING, path_mask: STRING, path_original_mask: STRING,
        min_x: BIGINT, min_y: BIGINT, max_x: BIGINT, max_y: BIGINT, width: INT, height: INT, region_count: INT, timestamp: STRING, `user`: STRING,
        version: INT, is_latest: INT, annotation_request: BIGINT, comment: STRING, labels: {_LABELS}>>>>>>>>>
"""

#: Rows of a verdict store.
VERDICT_DDL = "kind STRING, dataset_id STRING, key STRING, decision STRING, reason STRING, reviewer STRING, reviewed_at STRING, comment STRING, legacy_file_uid STRING"

#: Measurement tables: of masks, files and pairs.
MASKS_DDL = """dataset_id STRING, file_uid STRING, geometry_uid STRING, role STRING, `exists` BOOLEAN, read_error STRING, ndim INT, n_channels INT, dtype STRING,
height INT, width INT, value_min INT, value_max INT, unique_values ARRAY<INT>, truncated BOOLEAN, fg_pixels BIGINT, fg_ratio DOUBLE,
bbox STRUCT<min_x: INT, min_y: INT, max_x: INT, max_y: INT>, n_components INT, component_areas ARRAY<BIGINT>, component_areas_mm2 ARRAY<DOUBLE>, area_mm2 DOUBLE,
mask_hash STRING, lat_containment DOUBLE, lat_outside_mm2 DOUBLE, filled_iou_vs_mask DOUBLE, difference_ratio DOUBLE, reference_status STRING"""
FILES_DDL = "file_uid STRING, image_exists BOOLEAN, dicom_rows INT, dicom_columns INT, dicom_read_error STRING, n_annotations INT, n_masks INT, reference_status STRING"
PAIRS_DDL = """dataset_id STRING, file_uid STRING, uid_a STRING, uid_b STRING, iou DOUBLE, containment_a_in_b DOUBLE, containment_b_in_a DOUBLE,
pixel_identical BOOLEAN, same_label_keys BOOLEAN, both_latest BOOLEAN"""
