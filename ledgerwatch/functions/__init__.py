"""Column-level helpers shared by the operators (all JVM-side expressions)."""

from ledgerwatch.functions.scalar import (  # noqa: F401
    SEVERITY_ORDER,
    add_seconds,
    bucket_start,
    minutes_between,
    render_template,
    safe_divide,
    severity_at_least,
    severity_rank,
    sorted_label_entries,
)
