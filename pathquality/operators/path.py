"""The elements a session crosses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element type and the session column that names the element.
PATH_COLUMNS = (
    ("switch", "switch_id"),
    ("router", "router_id"),
    ("circuit", "circuit_id"),
    ("pop", "pop_id"),
    ("provider", "provider"),
    ("gateway", "probe_c2s"),
    ("gateway", "probe_s2c"),
    ("server", "server_id"),
    ("app", "app"),
)


def explode_path(
    sessions: DataFrame,
    keep: Sequence[str],
    path: Sequence[tuple[str, str]] = PATH_COLUMNS,
) -> DataFrame:
    """One row per session and distinct non-empty element, with the `keep` columns.

    Only two columns of the same type can name the same element, so repeats are blanked by
    comparing those; what is blank is dropped after the explode. Plain comparisons stay in
    generated code, which the array functions would leave.
    """
    steps = []
    for i, (kind, column) in enumerate(path):
        earlier = [c for k, c in path[:i] if k == kind]
        name = F.col(column)
        for other in earlier:
            name = F.when(F.col(column) == F.col(other), "").otherwise(name)
        steps.append(F.struct(F.lit(kind).alias("element_type"), name.alias("element_id")))
    crossed = sessions.select(*keep, F.inline(F.array(*steps)))
    return crossed.filter(F.col("element_id") != "")
