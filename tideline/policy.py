"""Policies: validated settings of each stage, as plain nested values.

A policy file (YAML) is laid over defaults. Values must have the default's type. Keys that
the defaults don't know are left out in the cleaning and time-series policies, and
are errors in the other two.
"""

from __future__ import annotations

import copy
from pathlib import Path
from typing import Any


class PolicyError(ValueError):
    pass


class Settings(dict):
    """A dict whose keys are attributes too."""

    def __getattr__(self, name: str) -> Any:
        try:
            return self[name]
        except KeyError:
            raise AttributeError(name) from None


#: Keys under which any name may stand, with the settings of one such name.
_FREE = object()
SEVERITIES = ("critical", "important", "aware", "normal")
FAMILIES = ("rolling_mean", "rolling_std", "rolling_trend", "lag", "pct_change", "velocity")


def _family(enabled: bool = True, windows: list[int] | None = None, lags: list[int] | None = None) -> dict:
    return {"enabled": enabled, "windows": windows or [5, 15, 60], "lags": lags or [1, 5, 15], "closed": "left"}


def _category(**families: dict) -> dict:
    return {name: families.get(name, _family(False)) for name in FAMILIES}


def _selector(patterns: list[str] = (), categories: list[str] = (), columns: list[str] = ()) -> dict:
    return {"enabled": True, "include_metadata": True, "include_patterns": list(patterns), "include_categories": list(categories), "include_columns": list(columns), "exclude_patterns": [], "exclude_columns": []}


def _bounds(severity: str, low: float, high: float, *names: str, integer: bool = False) -> dict:
    return {n: {"min": low, "max": high, "severity": severity, "integer": integer} for n in names}


# The shipped settings of the four stages.
CLEANING = {
    "timestamps": {"expected_period_s": 60.0, "gap_factor": 2.0, "max_legal_jump_s": 3600.0},
    "duplicates": {"payload_window_rows": 5, "burst_max_delta_s": 1.0, "burst_min_rows": 3},
    "frozen_sensors": {
        "frozen_min_minutes": 120,
        "epsilon_rate_cols": ["granulator_production_rate", "steam_valve_flow_me2"],
        "epsilon": 1e-6,
        "skip_columns": ["granulator_g2_state_pct", "conditioner_l2_state_pct", "feeder_al2_state_pct", "steam_dosing_valve_me2_pct"],
    },
    "missing_values": {"broken_sensor_min_run": 30, "interpolation_max_run": 5, "alarm_alignment_window_min": 10, "missing_by_design_columns": ["batch_id", "batch_quality_id"]},
    "physical_ranges": {
        "clip_soft_violations": False,
        "bounds": {
            **_bounds("critical", -20.0, 350.0, "conditioner_inlet_temp", "steam_valve_temp_me2", "feeder_hopper_temp", "conditioner_steam_loop_temp", "expander_ex2_outlet_temp", "inlet_hopper_temp", "conditioner_temp_sp"),
            **_bounds("critical", 0.0, 100.0, "steam_valve_pressure_me2"),
            **_bounds("critical", 0.0, 250.0, "expander_ex2_hydraulic_press"),
            **_bounds("critical", 0.0, 100.0, "steam_line_pressure_sp", "expander_cone_pressure_sp"),
            **_bounds("important", 0.0, 110.0, "granulator_power", "conditioner_l2_power", "expander_ex2_power", "feeder_max_speed_sp", "granulator_power_sp"),
            **_bounds("important", 0.0, 110.0, "granulator_g2_state_pct", "conditioner_l2_state_pct", "feeder_al2_state_pct", "steam_dosing_valve_me2_pct"),
            **_bounds("critical", 0.0, 100.0, "inlet_hopper_humidity"),
            **_bounds("critical", 0.0, 10000.0, "granulator_production_rate"),
            **_bounds("critical", 0.0, 100000.0, "steam_valve_flow_me2"),
            **_bounds("critical", 0.0, 10000.0, "extruder_specific_energy"),
            **_bounds("important", 0.0, 50.0, "granulator_roller_gap"),
            **_bounds("aware", 0.0, 1.0e9, "inlet_hopper_points"),
            **_bounds("critical", 0.0, 1.0, "granulator_g2_running", "granulator_g2_alarm", "conditioner_me2_alarm", "conditioner_me2_direct", "feeder_al2_running", "feeder_al2_alarm", integer=True),
        },
    },
    "state_consistency": {"min_production_kgmin": 0.1, "min_power_pct": 1.0, "alarm_shutdown_window_min": 10, "sp_pv_max_drift_pct": 20.0, "sp_pv_drift_min_minutes": 30, "hot_temperature_threshold_c": 200.0},
}
TIME_SERIES = {
    "temporal_conversion": {"enabled": True, "timestamp_col": "timestamp"},
    "temporal_index": {"enabled": True, "drop_duplicates_on_index": True},
    "resampling": {"enabled": False, "rule": "1min", "aggregations": {"process_sensor": "mean", "setpoint": "last", "state_flag": "max", "alarm": "max", "control": "mean"}},
    "state_features": {"enabled": True, "running_fraction_windows": [15, 60, 240], "time_since_active": True, "edge_count_windows": [60, 240]},
    "category_defaults": {
        "process_sensor": _category(rolling_mean=_family(windows=[5, 15, 60]), rolling_std=_family(windows=[5, 15, 60]), rolling_trend=_family(windows=[15, 60]), lag=_family(lags=[1, 5, 15]), pct_change=_family(lags=[1, 5]), velocity=_family(lags=[1])),
        "setpoint": _category(lag=_family(lags=[1])),
        "state_flag": _category(lag=_family(lags=[1])),
        "alarm": _category(lag=_family(lags=[1])),
        "control": _category(rolling_mean=_family(windows=[15, 60]), lag=_family(lags=[1, 5])),
    },
    "overrides": {"granulator_production_rate": {"windows": [5, 15, 60, 240]}, "inlet_hopper_points": {"disable_families": ["pct_change", "velocity"]}},
}
_SENSORS = ["process_sensor"]
ENGINEERING = {
    "temporal_derivatives": {
        "enabled": True,
        "acceleration": {"enabled": True, "lags": [1, 5], "categories": _SENSORS},
        "sign_change_rate": {"enabled": True, "windows": [15, 60], "categories": _SENSORS, "closed": "left"},
        "sp_pv_deviation": {
            "enabled": True,
            "pairs": {"granulator_power_sp": "granulator_power", "conditioner_temp_sp": "conditioner_steam_loop_temp", "steam_line_pressure_sp": "steam_valve_pressure_me2", "expander_cone_pressure_sp": "expander_ex2_hydraulic_press"},
        },
    },
    "stability": {
        "enabled": True,
        "cv": {"enabled": True, "windows": [15, 60], "categories": _SENSORS, "epsilon": 1e-6, "closed": "left"},
        "std_ratio": {"enabled": True, "short": 5, "long": 60, "categories": _SENSORS, "epsilon": 1e-6},
        "rolling_range": {"enabled": True, "windows": [15, 60], "categories": _SENSORS, "closed": "left"},
        "mad": {"enabled": True, "windows": [60], "categories": _SENSORS, "units": ["C", "bar"], "closed": "left"},
    },
    "physical_ratios": {
        "enabled": True,
        "epsilon": 1e-6,
        "nan_rate_warn": 0.5,
        "ratios": [
            {"name": "granulator_kwh_per_kg", "op": "ratio", "a": "granulator_power", "b": "granulator_production_rate"},
            {"name": "extruder_kwh_per_kg", "op": "scale", "a": "extruder_specific_energy", "factor": 0.001},
            {"name": "production_per_steam", "op": "ratio", "a": "granulator_production_rate", "b": "steam_valve_flow_me2"},
            {"name": "temp_rise_conditioner", "op": "diff", "a": "conditioner_steam_loop_temp", "b": "conditioner_inlet_temp"},
            {"name": "temp_rise_feeder", "op": "diff", "a": "feeder_hopper_temp", "b": "inlet_hopper_temp"},
            {"name": "power_balance_extruder_vs_conditioner", "op": "diff", "a": "expander_ex2_power", "b": "conditioner_l2_power"},
            {"name": "pressure_ratio_expander_steam", "op": "ratio", "a": "expander_ex2_hydraulic_press", "b": "steam_valve_pressure_me2"},
            {"name": "roller_gap_per_production", "op": "ratio", "a": "granulator_roller_gap", "b": "granulator_production_rate"},
        ],
    },
    "energetic_features": {
        "enabled": True,
        "sample_period_s": 60.0,
        "power_columns": ["granulator_power", "conditioner_l2_power", "expander_ex2_power"],
        "production_column": "granulator_production_rate",
        "cumulative": {"enabled": True, "daily_reset": True},
        "energy_per_kg": {"enabled": True, "windows": [60, 240], "epsilon": 1e-6, "closed": "left"},
        "per_cycle": {"enabled": False, "cycle_id_column": None},
    },
    "operative_features": {
        "enabled": True,
        "running_flags": ["granulator_g2_running", "feeder_al2_running", "conditioner_me2_direct"],
        "alarm_flags": ["granulator_g2_alarm", "feeder_al2_alarm", "conditioner_me2_alarm"],
        "time_since_machine_off": True,
        "n_subsystems_running": True,
        "cumulative_starts": True,
        "total_alarms": {"enabled": True, "windows": [60, 240], "closed": "left"},
        "time_since_any_alarm": True,
        "any_alarm_while_running": True,
    },
    "anomaly_features": {
        "enabled": True,
        "rolling_z": {"enabled": True, "windows": [60, 240], "categories": _SENSORS, "epsilon": 1e-6, "closed": "left"},
        "robust_z": {"enabled": True, "windows": [60], "categories": _SENSORS, "epsilon": 1e-6, "closed": "left"},
        "global_z": {"enabled": False, "categories": _SENSORS, "epsilon": 1e-6},
    },
}
DATASETS = {
    "master_validation": {"enabled": True, "require_monotonic_timestamps": True, "require_unique_timestamps": True, "max_nan_fraction_per_column": 0.30, "schema_lock": True, "drop_columns": ["drift"]},
    "anomaly_detection": _selector(
        [r"_cv_\d+$", r"_range_\d+$", r"_mad_\d+$", r"_stdratio_\d+_\d+$", r"_z_\d+$", r"_robust_z_\d+$", r"_z_global$", r"_accel_\d+$", r"_signchanges_\d+$", r"_tsla$", r"_edges_\d+$"],
        columns=["time_since_machine_off", "n_subsystems_running", "cumulative_starts", "time_since_any_alarm", "any_alarm_while_running"],
    ),
    "forecasting": _selector([r"_lag_\d+$", r"_pctchg_\d+$", r"_velocity_\d+$", r"_mean_\d+$", r"_std_\d+$", r"_trend_\d+$", r"_runfrac_\d+$", r"_minus_"], ["process_sensor"]),
    "energy": _selector(
        [r"_cumkwh$", r"_cumkwh_day$", r"_energy_per_kg_\d+$", r"_kwh_per_kg$", r"^production_per_steam$", r"^power_balance_", r"^pressure_ratio_", r"_runfrac_\d+$"],
        columns=[
            "granulator_power", "conditioner_l2_power", "expander_ex2_power", "extruder_specific_energy", "granulator_production_rate",
            "granulator_g2_state_pct", "conditioner_l2_state_pct", "feeder_al2_state_pct",
            "granulator_roller_gap", "steam_valve_flow_me2", "steam_valve_pressure_me2", "conditioner_steam_loop_temp", "conditioner_inlet_temp", "expander_ex2_outlet_temp", "inlet_hopper_humidity", "inlet_hopper_temp",
        ],
    ),
}

_BOUND = {"min": 0.0, "max": 0.0, "severity": "important", "integer": False}
_OVERRIDE = {"disable_families": [], "enable_families": [], "windows": None, "lags": None}
_FULL = {name: _family() for name in FAMILIES}
#: Paths below which names are free, with the defaults of what stands there (None: a plain value).
_OPEN = {
    ("physical_ranges", "bounds"): _BOUND,
    ("resampling", "aggregations"): None,
    ("category_defaults",): _FULL,
    ("overrides",): _OVERRIDE,
    ("temporal_derivatives", "sp_pv_deviation", "pairs"): None,
}
#: What a policy file that leaves a key out gets, where it isn't the shipped value.
_BARE = {
    ("physical_ranges", "bounds"): {}, ("category_defaults",): {}, ("overrides",): {}, ("temporal_derivatives", "sp_pv_deviation", "pairs"): {}, ("physical_ratios", "ratios"): [],
    ("energetic_features", "power_columns"): [], ("energetic_features", "production_column"): None, ("operative_features", "running_flags"): [], ("operative_features", "alarm_flags"): [],
    ("master_validation", "drop_columns"): [],
    ("frozen_sensors", "epsilon_rate_cols"): [], ("frozen_sensors", "skip_columns"): [], ("missing_values", "missing_by_design_columns"): [],
    ("anomaly_detection",): _selector(), ("forecasting",): _selector(), ("energy",): _selector(),
}
_RATIO = {"name", "op", "a", "b", "factor"}


def _wrap(value: Any) -> Any:
    if isinstance(value, dict):
        return Settings({k: _wrap(v) for k, v in value.items()})
    return [_wrap(v) for v in value] if isinstance(value, list) else value


def _merge(default: Any, given: Any, path: tuple[str, ...], strict: bool) -> Any:
    where = ".".join(path)
    if path in _OPEN:
        if not isinstance(given, dict):
            raise PolicyError(f"{where}: names and their settings are wanted")
        one = _OPEN[path]
        return {k: v if one is None else _merge(one, v, (*path, "*"), strict) for k, v in given.items()}
    if isinstance(default, dict):
        if not isinstance(given, dict):
            raise PolicyError(f"{where}: settings are wanted, not {given!r}")
        if strict and (unknown := set(given) - set(default)):
            raise PolicyError(f"{where or 'policy'}: unknown keys {sorted(unknown)}")
        return {k: _merge(v, given[k], (*path, k), strict) if k in given else copy.deepcopy(_BARE.get((*path, k), v)) for k, v in default.items()}
    if path == ("physical_ratios", "ratios"):
        for r in given:
            if set(r) - _RATIO or not {"name", "a"} <= set(r) or r.get("op", "ratio") not in ("ratio", "diff", "scale"):
                raise PolicyError(f"{where}: {r!r}")
        return [{"op": "ratio", "b": None, "factor": None} | r for r in given]
    if path[-1] == "severity" and given not in SEVERITIES:
        raise PolicyError(f"{where}: {given!r} is none of {SEVERITIES}")
    if path[-1] == "max_nan_fraction_per_column" and not 0 <= given <= 1:
        raise PolicyError(f"{where}: {given!r} isn't between 0 and 1")
    wanted = (int, float) if isinstance(default, float) else list if default is None and path[-1] in ("windows", "lags") else type(default)
    if default is not None and (not isinstance(given, wanted) or isinstance(given, bool) != isinstance(default, bool)):
        raise PolicyError(f"{where}: {given!r} isn't of the type of {default!r}")
    return float(given) if isinstance(default, float) else given


_STAGES = {"cleaning": (CLEANING, False), "time_series": (TIME_SERIES, False), "engineering": (ENGINEERING, True), "datasets": (DATASETS, True)}


def policy(stage: str, given: dict | None = None) -> Settings:
    """The shipped policy of a stage, or the one of given settings."""
    default, strict = _STAGES[stage]
    if given is None:
        out = copy.deepcopy(default)
        if stage == "engineering":
            out["physical_ratios"]["ratios"] = [{"op": "ratio", "b": None, "factor": None} | r for r in out["physical_ratios"]["ratios"]]
        if stage == "time_series":
            out["overrides"] = {k: _OVERRIDE | v for k, v in out["overrides"].items()}
        return _wrap(out)
    return _wrap(_merge(default, given, (), strict))


def load_policy(stage: str, path: str) -> Settings:
    """From a YAML file; a missing file is an error."""
    import yaml

    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(f"no {stage} policy at {path}")
    return policy(stage, yaml.safe_load(file.read_text(encoding="utf-8")) or {})


def families_of(time_series: Settings, category: str, column: str) -> Settings:
    """The effective families of a column: its category's (all of them in full if the policy has none), then its override: windows and lags replace those of every family, then families are disabled and enabled."""
    own = copy.deepcopy(time_series.category_defaults.get(category) or _wrap(_FULL))
    over = time_series.overrides.get(column)
    if over:
        for name, family in own.items():
            for key in ("windows", "lags"):
                if over[key] is not None:
                    family[key] = list(over[key])
            family["enabled"] = (family["enabled"] and name not in over["disable_families"]) or name in over["enable_families"]
    return own
