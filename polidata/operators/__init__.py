"""DataFrame -> DataFrame operators."""

from polidata.operators import aggregates, joins, quality, shape, windows  # noqa: F401
