"""Fixed values that must equal the reference's configuration for equal results.

FIXED VALUES (configuration of the test-rig logs, kept verbatim and in order):

Interim feature list, 27 sensors plus the step marker. Note the leading blank
in " Vibration 2" and the mixed case; both are part of the raw headers:
    "M1 SPEED", "M1 CURRENT", "M1 TORQUE",
    "D1 RPM", "D1 CURRENT", "D1 TORQUE",
    "M2 RPM", "M2 Amp", "M2 Torque",
    "CHARGE PT", "CHARGE FLOW",
    "M3 RPM", "M3 Amp", "M3 Torque",
    "Servo PT", "SERVO FLOW",
    "M5 RPM", "M5 Amp", "M5 Torque",
    "M6 RPM", "M6 Amp", "M6 Torque",
    "M7 RPM", "M7 Amp", "M7 Torque",
    "Vibration 1", " Vibration 2",
    "STEP"

Forecast targets (eleven):
    VIBRATION_1, VIBRATION_2, DRIVE_POWER, LOAD_POWER, CHARGE_MECH_POWER,
    CHARGE_HYD_POWER, SERVO_MECH_POWER, SERVO_HYD_POWER, SCAVENGE_POWER,
    MAIN_COOLER_POWER, GEARBOX_COOLER_POWER

Derived power columns (name: kind, inputs):
    DRIVE_POWER: mech (M1 SPEED, M1 TORQUE)
    LOAD_POWER: abs-mech (D1 RPM, D1 TORQUE)
    CHARGE_MECH_POWER: mech (M2 RPM, M2 Torque)
    CHARGE_HYD_POWER: hyd (CHARGE PT, CHARGE FLOW)
    SERVO_MECH_POWER: mech (M3 RPM, M3 Torque)
    SERVO_HYD_POWER: hyd (Servo PT, SERVO FLOW)
    SCAVENGE_POWER: mech (M5 RPM, M5 Torque)
    MAIN_COOLER_POWER: mech (M6 RPM, M6 Torque)
    GEARBOX_COOLER_POWER: mech (M7 RPM, M7 Torque)

Column names treated as time columns (not coerced): "TIME", " DATE", "DATE".
Columns dropped by the KFP-style cleaner: "DATE", " DATE", "DURATION", "NOT USED", "NOT_USED".
Raw file name rule: extension .csv / .xlsx / .xls and the text "RAW" in the name.
Characters stripped from the left of a file name before the unit is parsed: "-/HYDhyd0".
"""

from __future__ import annotations

INTERIM_FEATURES: list[str] = [
    "M1 SPEED", "M1 CURRENT", "M1 TORQUE",
    "D1 RPM", "D1 CURRENT", "D1 TORQUE",
    "M2 RPM", "M2 Amp", "M2 Torque",
    "CHARGE PT", "CHARGE FLOW",
    "M3 RPM", "M3 Amp", "M3 Torque",
    "Servo PT", "SERVO FLOW",
    "M5 RPM", "M5 Amp", "M5 Torque",
    "M6 RPM", "M6 Amp", "M6 Torque",
    "M7 RPM", "M7 Amp", "M7 Torque",
    "Vibration 1", " Vibration 2",
    "STEP",
]

FORECAST_FEATURES: list[str] = [
    "VIBRATION_1", "VIBRATION_2", "DRIVE_POWER", "LOAD_POWER", "CHARGE_MECH_POWER",
    "CHARGE_HYD_POWER", "SERVO_MECH_POWER", "SERVO_HYD_POWER", "SCAVENGE_POWER",
    "MAIN_COOLER_POWER", "GEARBOX_COOLER_POWER",
]

# (output column, kind, first input, second input); kind in {"mech", "abs_mech", "hyd"}
POWER_FEATURES: list[tuple[str, str, str, str]] = [
    ("DRIVE_POWER", "mech", "M1 SPEED", "M1 TORQUE"),
    ("LOAD_POWER", "abs_mech", "D1 RPM", "D1 TORQUE"),
    ("CHARGE_MECH_POWER", "mech", "M2 RPM", "M2 Torque"),
    ("CHARGE_HYD_POWER", "hyd", "CHARGE PT", "CHARGE FLOW"),
    ("SERVO_MECH_POWER", "mech", "M3 RPM", "M3 Torque"),
    ("SERVO_HYD_POWER", "hyd", "Servo PT", "SERVO FLOW"),
    ("SCAVENGE_POWER", "mech", "M5 RPM", "M5 Torque"),
    ("MAIN_COOLER_POWER", "mech", "M6 RPM", "M6 Torque"),
    ("GEARBOX_COOLER_POWER", "mech", "M7 RPM", "M7 Torque"),
]

TIME_COLUMNS: tuple[str, ...] = ("TIME", " DATE", "DATE")
KFP_DROP_COLUMNS: tuple[str, ...] = ("DATE", " DATE", "DURATION", "NOT USED", "NOT_USED")
RAW_EXTENSIONS: tuple[str, ...] = (".csv", ".xlsx", ".xls")
RAW_NAME_MARK = "RAW"
UNIT_STRIP_CHARS = "-/HYDhyd0"
STEP_COLUMN = "STEP"
TARGET_MARKS: tuple[str, ...] = ("POWER", "VIBRATION")
