"""The controlled vocabularies of dataset rows, tasks and answers."""

TASK_SCHEMA = ("rtl_task_v0.1", "rtl_task.v0.1")
ANSWER_SCHEMA = ("rtl_answer_v0.1", "rtl_answer.v0.1")
DATASET_VERSION = "dataset_v0.1"
TASK_TYPES = ("rtl_bug_review", "rtl_area_activity_review", "rtl_tool_report_explanation", "unsafe_optimization_rejection", "rtl_before_after_judgment")
USER_GOALS = (
    "find_correctness_bug", "reduce_switching_activity", "reduce_area", "explain_lint_log", "explain_synthesis_report",
    "explain_toggle_report", "compare_before_after", "suggest_safe_patch", "reject_unsafe_optimization",
)
CLAIM_LEVELS = ("suggestion_only", "tool_supported", "verified", "insufficient_evidence", "not_applicable")
CLAIM_DOMAINS = ("correctness", "area", "activity", "power")
SPLITS = ("train", "val", "validation", "test", "unsplit")
TRAINING_SPLITS = ("train", "val", "validation", "test")
SOURCES = (
    "handwritten_golden", "synthetic_rfid_style", "public_verilog_eval", "public_rtllm", "public_rtllm_2", "public_rtlfixer",
    "public_openllm_rtl", "teacher_generated", "llm_converted_public",
)
REVIEW_STATUSES = ("draft", "validated", "reviewed", "rejected", "teacher_distilled_unreviewed")
TOOLS = ("parse", "lint", "simulation", "equivalence", "synthesis", "toggle", "power")
TOOL_STATUSES = ("pass", "fail", "not_run", "unknown")
ARTIFACTS = ("rtl_code", "before_rtl_code", "after_rtl_code", "testbench", "synthesis_report", "toggle_report", "lint_log")
REQUIRED_OUTPUT = ("issue_summary", "time_reasoning", "space_reasoning", "safe_optimization", "functional_risk", "verification_plan", "claim_levels")
ROW_FIELDS = (
    "id", "dataset_version", "split", "source", "license", "design_family", "task_family", "created_by", "review_status",
    "provenance", "tool_checks", "messages",
)
PROVENANCE_FIELDS = ("origin", "public_dataset_name", "public_dataset_url", "source_commit", "notes")
ROLES = ("system", "user", "assistant")
CONSTRAINTS = (
    "preserve_top_level_interface", "preserve_cycle_level_behavior", "preserve_reset_behavior", "do_not_claim_power_without_power_report",
    "prefer_minimal_patch",
)
SUMMARY_FIELDS = (
    "top_module", "clock_signals", "reset_signals", "registered_signals", "combinational_blocks", "suspected_fsm_signals",
    "suspected_counters", "unused_enable_signals", "activity_hotspots",
)
CONTEXT_FIELDS = ("target_domain", "priority", "timing_policy")
EVIDENCE_TOOLS = {"correctness": ("simulation", "equivalence"), "area": ("synthesis",), "activity": ("toggle",), "power": ("power",)}
TOOL_ARTIFACTS = {"lint": "lint_log", "synthesis": "synthesis_report", "toggle": "toggle_report"}
SEVERITIES = ("low", "medium", "high")
ANSWER_FIELDS = (
    "schema_version", "task_type", "issue_summary", "time_reasoning", "space_reasoning", "safe_optimization", "functional_risk",
    "verification_plan", "claim_levels", "patch",
)
BLOCKS = ("always_ff", "always_comb", "always", "assign", "case")
SCHEMA_PAIR = "rtl_task_v0.1_to_rtl_answer_v0.1"
TEACHER_FIELDS = (
    "schema_version", "source_id", "task_type", "issue_summary", "time_reasoning", "space_reasoning", "safe_optimization",
    "functional_risk", "verification_plan", "claim_levels", "evidence_used", "limitations",
)
GENERIC_TEXT = ("requires review", "draft seed", "baseline", "no optimization effect", "not verified during import")
