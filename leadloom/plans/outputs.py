"""Writing the result tables of a plan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import fields

from pyspark.sql import DataFrame

from leadloom.sources.tables import write_table

# --- fixed values: table name endings -------------------------------------------------
ENDINGS = {
    "predictions": "model_predictions",
    "action_list": "rm_action_list",
    "importance": "feature_importance",
    "shap_importance": "shap_importance",
    "metadata": "model_metadata",
    "trials": "search_trials",
}
_HISTORY = ("metadata",)


def write_results(result, target: Mapping[str, str], prefix: str, batch: int = 1000) -> list[str]:
    """Write the tables of a plan result as ``<prefix>_<ending>`` and return their names.

    Each run replaces the tables, an empty action list included; run metadata is appended.
    """
    written = []
    for f in fields(result):
        frame = getattr(result, f.name)
        if f.name in ENDINGS and isinstance(frame, DataFrame):
            name = f"{prefix}_{ENDINGS[f.name]}"
            write_table(frame, target, name, "append" if f.name in _HISTORY else "overwrite", batch)
            written.append(name)
    return written
