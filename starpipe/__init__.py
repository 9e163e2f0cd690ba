"""starpipe: a Spark-native star-schema pipeline.

Raw operational tables -> conformed staging -> cleaned tables (latest
record per business key) -> dimensions and facts with dense surrogate
keys -> data-quality reports and business metrics, all as lazy
DataFrame plans.

Sub-packages:

* ``sources``   - table IO, copy manifest, staging fixtures
* ``functions`` - column expressions (safe casts, date keys, minutes)
* ``operators`` - reusable DataFrame operators (conform, dedup, keys,
  lookups, quality profiles, date spine)
* ``plans``     - the pipeline's products (clean, model, KPIs) and the
  query registry
* ``llm``       - operators of a training-data pipeline (nothing else imports it)
"""

__version__ = "0.1.0"

from starpipe.functions.scalar import date_key, duration_minutes, safe_cast, valid_date  # noqa: E402
from starpipe.operators.conform import apply_mapping, conform  # noqa: E402
from starpipe.operators.dedup import latest_per_key, version_history  # noqa: E402
from starpipe.operators.keys import add_key  # noqa: E402
from starpipe.operators.lookup import lookup_key, orphans, star_lookup  # noqa: E402
from starpipe.plans.pipeline import run_pipeline  # noqa: E402
from starpipe.sources.io import read_table, save_table  # noqa: E402

__all__ = [
    "add_key", "apply_mapping", "conform", "date_key", "duration_minutes", "latest_per_key",
    "lookup_key", "orphans", "read_table", "run_pipeline", "safe_cast", "save_table",
    "star_lookup", "valid_date", "version_history",
]
