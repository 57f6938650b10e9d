"""Explicit schemas of the record stores, as DDL; no reader infers one."""

from __future__ import annotations

JOBS = (
    "id string, kind string, status string, stage string, progress double, input_path string, output_path string, "
    "report_path string, error string, result_media_type string, metadata_json string, created_at timestamp, updated_at timestamp"
)
VARIANTS = (
    "harness_id string, parent_id string, description string, status string, conformance_rate double, manual_review_rate double, "
    "destructive_edit_count int, avg_seconds double, total_docs int, passed_docs int, created_at timestamp, retired_at timestamp, "
    "promoted_at timestamp, harness_config_json string"
)
EXPERIMENTS = (
    "experiment_id string, harness_id string, document_hash string, document_format string, document_type string, "
    "violation_types array<string>, fix_sequence array<struct<op_id:string,action:string>>, violations_before int, violations_after int, "
    "passed boolean, elapsed_seconds double, confidence double, quality_dimensions map<string,double>, "
    "behavioral_results map<string,boolean>, error string, created_at timestamp"
)
CALIBRATIONS = "judge_id string, judge_version string, format string, dimension string, cohens_kappa double, sample_size int, measured_at string"
MANIFEST = (
    "source string, output string, status string, elapsed_seconds double, acceptance_passed boolean, clean boolean, "
    "checker_failures array<map<string,string>>, manual_checks array<map<string,string>>, screen_reader_errors array<map<string,string>>, "
    "verapdf_violations array<map<string,string>>, verapdf_passed boolean, non_blocking_verapdf_warnings int, visual_diff map<string,string>, "
    "warning_reasons array<string>, fix_changes array<string>, fix_skipped array<string>, error string, completed_at string, root string, "
    "level string, level_blocking array<string>, needs_human array<string>, sub_scores map<string,double>"
)
REVIEW_QUEUE = (
    "doc_id string, format string, source_path string, source_sha256 string, document_class string, weak_dimensions array<string>, "
    "priority_score double, priority_reasons array<string>, sampled_at timestamp, status string, claimed_by string, claimed_at timestamp, "
    "completed_by string, completed_at timestamp"
)
STRUCT_NODES = "doc_id long, seq int, depth int, tag string, text string, alt_text string, page int, children_count int, has_content boolean"
FINDINGS = "doc_id long, rule_id string, severity string, page int, element string, description string"
BBOXES = "doc_id long, page int, idx int, left double, bottom double, right double, top double"
TEXT_LINES = "doc_id long, page int, seq int, text string, size double, bold boolean"
LINKS = "doc_id long, link_index int, text string, target string, source string"
