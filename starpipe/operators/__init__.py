"""Reusable DataFrame operators."""

from starpipe.operators.conform import apply_mapping, conform  # noqa: F401
from starpipe.operators.dedup import LATEST_ORDER, dedup, latest_per_key  # noqa: F401
from starpipe.operators.keys import add_key  # noqa: F401
from starpipe.operators.lookup import (  # noqa: F401
    fanout_rows,
    lookup_key,
    orphans,
    resolve_parent,
    star_lookup,
)
