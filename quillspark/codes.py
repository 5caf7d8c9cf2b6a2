"""Stable codes of findings, and the exception that carries one."""

from __future__ import annotations

#: The stable codes. Those of opening archives, running templates and loading models (DATASET_MISSING,
#: DATASET_ARCHIVE_UNREADABLE, DATASET_CHAT_TEMPLATE_MISSING, CONFIG_INVALID_JSON, CONFIG_METHOD_UNSUPPORTED) are names
#: for callers; the engine's operators give the others.
DATASET_CODES = [
    "DATASET_MISSING",
    "DATASET_ARCHIVE_UNREADABLE",
    "DATASET_ARCHIVE_UNSAFE",
    "DATASET_ARCHIVE_TOO_LARGE",
    "DATASET_ARCHIVE_NESTED",
    "DATASET_ARCHIVE_DUPLICATE_MEMBER",
    "DATASET_SPLIT_MISSING",
    "DATASET_SPLIT_AMBIGUOUS",
    "DATASET_WRONG_PIPELINE",
    "DATASET_SPLIT_TOO_LARGE",
    "DATASET_INVALID_UTF8",
    "DATASET_INVALID_JSON",
    "DATASET_SCHEMA_MIXED",
    "DATASET_SCHEMA_UNKNOWN",
    "DATASET_ROLE_INVALID",
    "DATASET_TARGET_EMPTY",
    "DATASET_LINE_TOO_LARGE",
    "DATASET_TOO_FEW_EXAMPLES",
    "DATASET_TOO_MANY_EXAMPLES",
    "DATASET_SEQUENCE_TOO_LONG",
    "DATASET_TOKEN_BUDGET_EXCEEDED",
    "DATASET_CHAT_TEMPLATE_MISSING",
    "DATASET_SPLIT_LEAKAGE",
]
MODEL_CODES = [
    "MODEL_KEY_MISSING",
    "MODEL_NOT_APPROVED",
    "MODEL_DISABLED",
    "MODEL_REMOTE_CODE_BLOCKED",
    "MODEL_REVISION_UNPINNED",
    "MODEL_BASE_MODEL_CONFLICT",
]
CONFIG_CODES = [
    "CONFIG_INVALID_JSON",
    "CONFIG_SCHEMA_INVALID",
    "CONFIG_OUT_OF_BOUNDS",
    "CONFIG_METHOD_UNSUPPORTED",
]
ARTIFACT_CODES = [
    "ARTIFACT_VERIFICATION_FAILED",
]


class Refused(ValueError):
    """Input that an operator refuses: a stable code and details without row content."""

    def __init__(self, code: str, message: str = "", **details: object) -> None:
        super().__init__(f"{code}: {message}" if message else code)
        self.code, self.details = code, details


def raise_first(report, order: str = "line_no") -> None:
    """Raise the first row of report (code, ...) that has a code, in the given order."""
    row = report.filter("code is not null").orderBy(*[c for c in ("split", order) if c in report.columns]).limit(1).collect()
    if row:
        found = row[0].asDict()
        raise Refused(found.pop("code"), **{k: v for k, v in found.items() if not isinstance(v, (list, dict)) and k != "value"})
