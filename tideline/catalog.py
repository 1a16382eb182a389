"""The catalogue of telemetry variables, and the groups that policies refer to."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The 37 columns in file order, as (name, type, category, objective, unit).
VARIABLES = [
    ("timestamp", "datetime", "Metadata", "-", ""),
    ("work_order", "categorical", "Metadata", "-", ""),
    ("deposit_equipment_id", "categorical", "Metadata", "-", ""),
    ("batch_id", "categorical", "Metadata", "-", ""),
    ("batch_quality_id", "categorical", "Metadata", "-", ""),
    ("feeder_max_speed_sp", "float", "Control", "-", "%"),
    ("steam_line_pressure_sp", "float", "Control", "-", "bar"),
    ("granulator_power_sp", "float", "Control", "-", "%"),
    ("conditioner_temp_sp", "float", "Control", "-", "C"),
    ("expander_cone_pressure_sp", "float", "Control", "-", "bar"),
    ("conditioner_inlet_temp", "float", "Process", "anomaly_detection", "C"),
    ("granulator_roller_gap", "float", "Process", "anomaly_detection", "mm"),
    ("granulator_power", "float", "Process", "energy_consumption", "%"),
    ("steam_valve_temp_me2", "float", "Process", "anomaly_detection", "C"),
    ("steam_valve_flow_me2", "float", "Process", "anomaly_detection", "kg/h"),
    ("steam_valve_pressure_me2", "float", "Process", "anomaly_detection", "bar"),
    ("granulator_production_rate", "float", "Process", "production_rate", "kg/min"),
    ("granulator_g2_state_pct", "float", "Control", "-", "%"),
    ("granulator_g2_running", "bool", "State", "-", ""),
    ("granulator_g2_alarm", "bool", "State", "machine_failure", ""),
    ("conditioner_l2_state_pct", "float", "Control", "-", "%"),
    ("conditioner_me2_alarm", "bool", "State", "machine_failure", ""),
    ("conditioner_me2_direct", "bool", "State", "-", ""),
    ("feeder_hopper_temp", "float", "Process", "anomaly_detection", "C"),
    ("conditioner_l2_power", "float", "Process", "energy_consumption", "%"),
    ("conditioner_steam_loop_temp", "float", "Process", "temperature_forecasting", "C"),
    ("expander_ex2_power", "float", "Process", "energy_consumption", "%"),
    ("expander_ex2_hydraulic_press", "float", "Process", "pressure_forecasting", "bar"),
    ("feeder_al2_state_pct", "float", "Control", "-", "%"),
    ("feeder_al2_running", "bool", "State", "-", ""),
    ("feeder_al2_alarm", "bool", "State", "machine_failure", ""),
    ("steam_dosing_valve_me2_pct", "float", "Control", "-", "%"),
    ("expander_ex2_outlet_temp", "float", "Process", "temperature_forecasting", "C"),
    ("extruder_specific_energy", "float", "Process", "energy_consumption", "kWh/t"),
    ("inlet_hopper_humidity", "float", "Process", "product_humidity", "%"),
    ("inlet_hopper_points", "float", "Process", "anomaly_detection", ""),
    ("inlet_hopper_temp", "float", "Process", "temperature_forecasting", "C"),
]
FORECAST_OBJECTIVES = ("temperature_forecasting", "pressure_forecasting")


def semantic_category(name: str, category: str | None) -> str | None:
    """The group that feature policies use; the first rule that fits."""
    if name == "timestamp" or category == "Metadata":
        return None
    if name.endswith("_alarm"):
        return "alarm"
    if name.endswith(("_running", "_direct")):
        return "state_flag"
    if category == "Control":
        return "setpoint" if name.endswith("_sp") else "control"
    return {"Process": "process_sensor", "State": "state_flag"}.get(category)


@dataclass(frozen=True)
class Catalog:
    """Category, unit and objective of each known column."""

    category: dict[str, str]
    unit: dict[str, str] = field(default_factory=dict)
    objective: dict[str, str] = field(default_factory=dict)

    @classmethod
    def default(cls) -> Catalog:
        return cls({v[0]: v[2] for v in VARIABLES}, {v[0]: v[4] for v in VARIABLES}, {v[0]: v[3] for v in VARIABLES})

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Catalog:
        """From a classification table in CSV: Variable, Category, Unity, Potential_Objective. It has a row for each column of the table, so it is small."""
        rows = spark.read.csv(path, header=True).select("Variable", "Category", "Unity", "Potential_Objective").collect()
        return cls({r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}, {r[0]: r[3] for r in rows})

    def of(self, name: str) -> str | None:
        return semantic_category(name, self.category.get(name))

    def in_category(self, columns: list[str], *kinds: str) -> list[str]:
        return [c for c in columns if self.of(c) in kinds]

    def with_unit(self, columns: list[str], *units: str) -> list[str]:
        return [c for c in columns if self.unit.get(c) in units]

    @property
    def metadata(self) -> list[str]:
        return [c for c, k in self.category.items() if k == "Metadata" and c != "timestamp"]

    def process(self, columns: list[str]) -> list[str]:
        return [c for c in columns if self.category.get(c) == "Process"]

    def running(self, columns: list[str]) -> list[str]:
        return [c for c in columns if c.endswith(("_running", "_direct"))]

    def alarms(self, columns: list[str]) -> list[str]:
        return [c for c in columns if c.endswith("_alarm")]


def telemetry_schema() -> T.StructType:
    kinds = {"datetime": T.TimestampType(), "categorical": T.StringType()}
    return T.StructType([T.StructField(v[0], kinds.get(v[1], T.DoubleType())) for v in VARIABLES])


def dictionary(spark: SparkSession, units: dict[str, str] | None = None, sensors: dict[str, str] | None = None) -> DataFrame:
    """The variable dictionary: a row for each column, with unit and sensor code from the file header if given."""
    rows = [(v[0], v[1], normal_unit((units or {}).get(v[0], v[4])), (sensors or {}).get(v[0], "")) for v in VARIABLES]
    return spark.createDataFrame(rows, "Variable string, Type string, Unity string, Sensor string")


# Spellings of units in file headers, and what they become.
UNIT_NAMES = {
    "": "-",
    "ºC": "C",
    "\ufffdC": "C",
    "Binari (0/1)": "0/1",
    "State": "0/1",
    "Kg/h": "kg/h",
    "Kg/min": "kg/min",
    "Kwh/T": "kWh/t",
}


def normal_unit(unit: str | None) -> str:
    raw = (unit or "").strip()
    return UNIT_NAMES.get(raw, raw)


def classification(spark: SparkSession, names: DataFrame | None = None) -> DataFrame:
    """The classification table; names (column Variable) must be the catalogue's, neither more nor fewer."""
    rows = [(v[0], v[2], v[4], v[3]) for v in VARIABLES]
    own = spark.createDataFrame(rows, "Variable string, Category string, Unity string, Potential_Objective string")
    if names is not None:
        extra, lacking = names.join(own, "Variable", "left_anti").collect(), own.join(names, "Variable", "left_anti").collect()
        if extra or lacking:
            raise ValueError(f"not in the classification: {[r[0] for r in extra]}; not in the dictionary: {[r[0] for r in lacking]}")
    return own
