"""Fixed values that results depend on (category lists, maps, conversion factors,
score cut points).  They are stated once, here, in their natural order."""

# ---- fixed values: category harmonisation --------------------------------------------
RACE_MAP = {
    "White": "White",
    "Black or African American": "Black",
    "Black or African-American": "Black",
    "Asian": "Asian",
    "Other": "Others",
    "Unknown": "Others",
    "Did Not Encounter": "Others",
    "Refusal": "Others",
    "American Indian or Alaska Native": "Others",
    "Native Hawaiian or Other Pacific Islander": "Others",
}
RACE_DEFAULT = "Others"

ETHNICITY_MAP = {
    "Non-Hispanic": "Not Hispanic or Latino",
    "Hispanic": "Hispanic or Latino",
    "Not Hispanic or Latino": "Not Hispanic or Latino",
    "Hispanic or Latino": "Hispanic or Latino",
    "Did Not Encounter": "Not Hispanic or Latino",
    "Refusal": "Not Hispanic or Latino",
    "*Unspecified": "Not Hispanic or Latino",
}
ETHNICITY_DEFAULT = "Not Hispanic or Latino"

DEATH_PATTERN = "dead|expired|death|died"

# ---- fixed values: cohort rules --------------------------------------------------------
ICU = "ICU"
PROCEDURAL = {"procedural": "OR"}
OR_AS_ICU = "OR"
THRESHOLD = 0.208

# ---- fixed values: vasoactive drugs and dose units ---------------------------------------
REQUIRED_MEDS = ["norepinephrine", "epinephrine", "phenylephrine", "vasopressin", "dopamine",
                 "angiotensin", "dobutamine", "milrinone"]

# unit -> (factor, divide by weight); the target unit is mcg/kg/min (units/min for vasopressin)
_CATECHOLAMINE_UNITS = [
    ("mcg/kg/min", 1.0, False),
    ("mcg/kg/hr", 1.0 / 60.0, False),
    ("mg/kg/hr", 1000.0 / 60.0, False),
    ("mcg/min", 1.0, True),
    ("mg/hr", 1000.0 / 60.0, True),
]
_ANGIOTENSIN_UNITS = [
    ("ng/kg/min", 1.0 / 1000.0, False),
    ("ng/kg/hr", 1.0 / 1000.0 / 60.0, False),
]
_VASOPRESSIN_UNITS = [
    ("units/min", 1.0, False),
    ("units/hr", 1.0 / 60.0, False),
    ("milliunits/min", 1.0 / 1000.0, False),
    ("milliunits/hr", 1.0 / 1000.0 / 60.0, False),
]
_CATECHOLAMINES = ["norepinephrine", "epinephrine", "phenylephrine", "dopamine", "milrinone",
                   "dobutamine"]


def dose_factor_rows():
    """The 36 (drug, unit, factor, per_weight) rows."""
    rows = [(d, u, f, w) for d in _CATECHOLAMINES for u, f, w in _CATECHOLAMINE_UNITS]
    rows += [("angiotensin", u, f, w) for u, f, w in _ANGIOTENSIN_UNITS]
    rows += [("vasopressin", u, f, w) for u, f, w in _VASOPRESSIN_UNITS]
    return rows


# ---- fixed values: ventilation ----------------------------------------------------------
REQUIRED_MODES = ["Assist Control-Volume Control", "Pressure Control",
                  "Pressure-Regulated Volume Control", "SIMV", "Pressure Support/CPAP",
                  "Volume Support", "Other"]
NO_MODE = "No mode documented"
VENT_MODES_FOR_DEVICE = ["simv", "pressure-regulated volume control",
                         "assist control-volume control"]
DEVICE_RANK = ["Vent", "NIPPV", "CPAP", "High Flow NC", "Face Mask", "Trach Collar",
               "Nasal Cannula", "Other", "Room Air"]
VENTILATED_DEVICES = ["IMV", "Vent"]
PEEP_RANGE = (0.0, 30.0)
FIO2_RANGE = (0.21, 1.0)

# ---- fixed values: organ score plausibility ranges ----------------------------------------
VITAL_FLOORS = {"spo2": 60.0, "map": 30.0}
LAB_RANGES = {
    "creatinine": (0.0, 20.0),
    "bilirubin_total": (0.0, 80.0),
    "po2_arterial": (30.0, 700.0),
    "platelet_count": (0.0, 2000.0),
}
# ---- fixed values: the unit in which a laboratory category is accepted (standard results only) --
LAB_UNITS = [
    ("monocyte", "%"),
    ("lymphocyte", "%"),
    ("basophil", "%"),
    ("neutrophil", "%"),
    ("albumin", "g/dL"),
    ("ast", "U/L"),
    ("total_protein", "g/dL"),
    ("alkaline_phosphatase", "U/L"),
    ("bilirubin_total", "mg/dL"),
    ("bilirubin_conjugated", "mg/dL"),
    ("calcium", "mg/dL"),
    ("chloride", "mmol/L"),
    ("potassium", "mmol/L"),
    ("sodium", "mmol/L"),
    ("glucose_serum", "mg/dL"),
    ("hemoglobin", "g/dL"),
    ("platelet count", "K/uL"),
    ("wbc", "K/uL"),
]
LABS_WORST_IS_MAX = ["creatinine", "bilirubin_total"]
LABS_WORST_IS_MIN = ["po2_arterial", "platelet_count"]

# ---- fixed values: calibration and sweeps -------------------------------------------------
CALIBRATION_BINS = 10
FIXED_EDGES = [round(0.05 * k, 2) for k in range(1, 20)]   # 0.05 ... 0.95
SWEEP_STEPS = 100                                            # q = 1.00, 0.99, ..., 0.01
BOOTSTRAP_REPLICATES = 1000
