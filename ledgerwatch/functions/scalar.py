"""Scalar Column helpers.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Log severities in ascending order, as defined by the public
# Cloud Logging LogSeverity enum (name -> numeric level).
SEVERITY_ORDER = {
    "DEFAULT": 0,
    "DEBUG": 100,
    "INFO": 200,
    "NOTICE": 300,
    "WARNING": 400,
    "ERROR": 500,
    "CRITICAL": 600,
    "ALERT": 700,
    "EMERGENCY": 800,
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def severity_rank(severity: Column | str) -> Column:
    """Numeric level of a severity name (unknown or NULL -> NULL)."""
    levels = F.create_map(*[x for k, v in SEVERITY_ORDER.items() for x in (F.lit(k), F.lit(v))])
    return levels[F.upper(_col(severity))]


def severity_at_least(severity: Column | str, floor: str) -> Column:
    """``severity>=FLOOR`` as in a log filter; NULL severities never match."""
    return F.coalesce(severity_rank(severity) >= F.lit(SEVERITY_ORDER[floor.upper()]), F.lit(False))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """NULL instead of an error (or infinity) when the denominator is 0 or NULL."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def bucket_start(ts: Column | str, period_seconds: Column | int) -> Column:
    """Start of the half-open ``[start, start+period)`` bucket on the epoch grid.

    ``period_seconds`` may be a column, so one pass can align series that use
    different periods.  Works on ``timestamp_ntz`` values (UTC wall clock).
    """
    period_us = (period_seconds if isinstance(period_seconds, Column)
                 else F.lit(int(period_seconds))).cast("long") * F.lit(1_000_000)
    # wall-clock arithmetic on timestamp_ntz: independent of the session time zone
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, _col(ts).cast("timestamp_ntz"))
    return F.timestamp_add("MICROSECOND", micros - F.pmod(micros, period_us), epoch)


def add_seconds(ts: Column | str, seconds: Column | int) -> Column:
    s = seconds if isinstance(seconds, Column) else F.lit(int(seconds))
    return F.timestamp_add("SECOND", s, _col(ts))


def sorted_label_entries(labels: Column | str) -> Column:
    """Canonical, groupable form of a label map: entries sorted by key."""
    return F.array_sort(F.map_entries(_col(labels)))


_TEMPLATE_VAR = re.compile(r"\$\{([A-Za-z0-9_.]+)\}")


def render_template(template: str, variables: Mapping[str, Column]) -> Column:
    """Render ``"... ${metric.labels.dag_id} ..."`` against Columns.

    The template is split at plan time; each ``${name}`` becomes the matching
    Column (NULL renders as an empty string).  Unknown names stay literal.
    """
    parts: list[Column] = []
    pos = 0
    for m in _TEMPLATE_VAR.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        name = m.group(1)
        if name in variables:
            parts.append(F.coalesce(variables[name].cast("string"), F.lit("")))
        else:
            parts.append(F.lit(m.group(0)))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")
