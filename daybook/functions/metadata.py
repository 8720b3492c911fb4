"""Column helpers for metadata maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.schema import RESERVED_META


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stored_meta(meta) -> Column:
    """The map without reserved keys; a null value is kept as the text 'None'."""
    kept = F.map_filter(_col(meta), lambda k, v: ~k.isin(RESERVED_META))
    return F.transform_values(kept, lambda k, v: F.coalesce(v, F.lit("None")))


def meta_json(meta) -> Column:
    """Registry metadata as JSON with sorted keys, reserved keys removed; empty becomes null."""
    kept = F.map_filter(_col(meta), lambda k, v: ~k.isin(RESERVED_META))
    ordered = F.map_from_entries(F.array_sort(F.map_entries(kept)))
    return F.when(F.size(kept) > 0, F.to_json(ordered, {"ignoreNullFields": "false"}))
