"""Column-level functions: null-strict aggregates, text, dates and code rules."""

from polidata.functions import civics, columns, dates, nullsafe, text  # noqa: F401
