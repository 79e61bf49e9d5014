"""Standard gates of the layers and the catalogue derived from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from .. import fixed_values as fixed
from ..operators import rules as R
from ..operators.gates import BLOCK, Gate
from ..sources.workspace import literal_rows
from ..spec import NUMBER, WEATHER, TableSpec

# severity a rule can raise, for the catalogue
RULE_SEVERITIES = {
    "schema_drift": "critical (missing) / warning (extra)",
    "null_check": "warning (critical above 10%)",
    "range_check": "warning",
    "unique_check": "critical",
    "freshness_check": "warning",
}


def layer_rules(layer: str, spec: TableSpec = WEATHER) -> list[R.Rule]:
    """Rules of one layer: shape at bronze, content at silver, identity at gold."""
    required = [f.name for f in spec.required]
    first_measure = next((f.name for f in spec.required if f.kind == NUMBER), None)
    if layer == "bronze":
        raw = spec.raw_columns or tuple(f.name for f in spec.fields)
        return [R.schema_drift(raw), R.null_check([spec.entity, spec.event_time])]
    if layer == "silver":
        judged = [f for f in spec.ranged if spec.gated is None or f.name in spec.gated]
        content = [spec.entity] + ([first_measure] if first_measure else [])
        content += [c for c in required if c not in content and c != spec.event_time]
        return [
            R.schema_drift(spec.clean_columns),
            R.null_check(content),
            *[R.range_check(f.name, f.low, f.high) for f in judged],
        ]
    if layer == "gold":
        identity = [spec.entity] + ([first_measure] if first_measure else []) + [spec.event_time]
        return [R.null_check(identity), R.unique_check(spec.key)]
    raise ValueError(f"Unknown medallion layer: {layer!r}")


def layer_gate(layer: str, mode: str = BLOCK, run_id: str = "", spec: TableSpec = WEATHER) -> Gate:
    return Gate(f"{layer}_quality_gate", mode, run_id, layer_rules(layer, spec))


def rule_catalogue(spark: SparkSession, spec: TableSpec = WEATHER) -> DataFrame:
    """Every rule with the layer it is wired to, derived from the gates themselves."""
    wired = [(layer, rule) for layer in fixed.LAYERS for rule in layer_rules(layer, spec)]
    wired.append((None, R.freshness(spec.event_time, dt.datetime(1970, 1, 1))))
    rows = [
        {
            "rule_name": rule.name,
            "layer": layer,
            "columns": rule.describe.get("columns", ""),
            "severity": RULE_SEVERITIES[rule.name],
            "state": "active" if layer else "not wired",
        }
        for layer, rule in wired
    ]
    return literal_rows(
        spark, rows, "rule_name string, layer string, columns string, severity string, state string"
    )
