"""Record and table schemas plus the fixed lookup values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

METRIC = T.StructType([
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])

LOCATION = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

# Output of a source normaliser, before timestamps are parsed and ids assigned.
PRE_RECORD = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("occurrence", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("sub_type", T.StringType()),
    T.StructField("ts_text", T.StringType()),
    T.StructField("metrics", T.MapType(T.StringType(), METRIC)),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("times_text", T.MapType(T.StringType(), T.StringType())),
    T.StructField("symptoms", T.ArrayType(T.StringType())),
    T.StructField("location", LOCATION),
    T.StructField("raw_data", T.StringType()),
    T.StructField("problem", T.StringType()),
])

# The normalised health record (one row per record, open fields in maps).
RECORD = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("date_only", T.DateType()),
    T.StructField("source", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("sub_type", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("metrics", T.MapType(T.StringType(), METRIC)),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("times", T.MapType(T.StringType(), T.TimestampType())),
    T.StructField("symptoms", T.ArrayType(T.StringType())),
    T.StructField("location", LOCATION),
    T.StructField("raw_data", T.StringType()),
    T.StructField("origin", T.StringType()),
])

REJECT = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("sub_type", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("ts_text", T.StringType()),
    T.StructField("raw_data", T.StringType()),
])

SOURCES = ["gyroscope", "nike_plus", "apple_health", "coach_me",
           "sleep_tracker", "manual_health", "moves"]
DATA_TYPES = ["fitness", "health", "sleep", "habits", "location", "mixed"]

# Names of the relational tables (parent first).
TABLES = ["health_records", "fitness_metrics", "health_vitals", "sleep_sessions",
          "habits", "symptoms", "medications", "location_data"]
CHILD_TABLES = TABLES[1:]

# --------------------------------------------------------------------------
# Fixed values.  These must equal the exporting apps' conventions and the
# behaviour users of the original tool rely on; they are data, not logic.
# --------------------------------------------------------------------------

# Timestamp text formats accepted, in order (Spark datetime patterns).
TS_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd-HH:mm:ss",
    "yyyy-MM-dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "yyyy-MM-dd HH:mm Z",
    "yyyy-MM-dd HH:mm:ss Z",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "EEE MMM dd HH:mm:ss yyyy",
]
TS_OUTPUT_FORMAT = "MM/dd/yyyy HH:mm:ss"
DATE_OUTPUT_FORMAT = "MM/dd/yyyy"

# Activity-app CSV: file type -> data type.
GYRO_FILE_TYPES = {
    "steps": "fitness", "running": "fitness", "cycling": "fitness",
    "workouts": "fitness", "sleep": "sleep", "bp": "health",
    "glucose": "health", "hrv": "health", "rhr": "health", "mood": "health",
    "meditation": "health", "symptoms": "health", "injuries": "health",
    "ketones": "health", "gvisits": "location", "photos": "media",
}
GYRO_FILE_PATTERN = r"gyroscope-\w+-(\w+)-export\.csv"
GYRO_TS_FIELDS = ["timestamp", "date", "time", "Time", "Start Time",
                  "start_time", "End Time", "end_time"]

# Phone-health XML: record type -> data type (unlisted types are dropped).
APPLE_TYPES = {
    "HKQuantityTypeIdentifierStepCount": "fitness",
    "HKQuantityTypeIdentifierDistanceWalkingRunning": "fitness",
    "HKQuantityTypeIdentifierActiveEnergyBurned": "fitness",
    "HKQuantityTypeIdentifierBasalEnergyBurned": "fitness",
    "HKQuantityTypeIdentifierFlightsClimbed": "fitness",
    "HKQuantityTypeIdentifierAppleExerciseTime": "fitness",
    "HKQuantityTypeIdentifierAppleStandTime": "fitness",
    "HKQuantityTypeIdentifierHeartRate": "health",
    "HKQuantityTypeIdentifierRestingHeartRate": "health",
    "HKQuantityTypeIdentifierWalkingHeartRateAverage": "health",
    "HKQuantityTypeIdentifierHeartRateVariabilitySDNN": "health",
    "HKQuantityTypeIdentifierBloodPressureSystolic": "health",
    "HKQuantityTypeIdentifierBloodPressureDiastolic": "health",
    "HKQuantityTypeIdentifierBloodGlucose": "health",
    "HKQuantityTypeIdentifierBodyMass": "health",
    "HKQuantityTypeIdentifierHeight": "health",
    "HKQuantityTypeIdentifierBodyMassIndex": "health",
    "HKQuantityTypeIdentifierBodyFatPercentage": "health",
    "HKQuantityTypeIdentifierLeanBodyMass": "health",
    "HKQuantityTypeIdentifierOxygenSaturation": "health",
    "HKQuantityTypeIdentifierBodyTemperature": "health",
    "HKQuantityTypeIdentifierRespiratoryRate": "health",
    "HKQuantityTypeIdentifierVO2Max": "health",
    "HKQuantityTypeIdentifierBloodAlcoholContent": "health",
    "HKQuantityTypeIdentifierDietaryWater": "health",
    "HKQuantityTypeIdentifierDietaryEnergyConsumed": "health",
    "HKQuantityTypeIdentifierDietaryCarbohydrates": "health",
    "HKQuantityTypeIdentifierDietaryProtein": "health",
    "HKQuantityTypeIdentifierDietaryFatTotal": "health",
    "HKQuantityTypeIdentifierDietaryFiber": "health",
    "HKQuantityTypeIdentifierDietarySugar": "health",
    "HKQuantityTypeIdentifierDietarySodium": "health",
    "HKQuantityTypeIdentifierEnvironmentalAudioExposure": "health",
    "HKQuantityTypeIdentifierPhysicalEffort": "fitness",
    "HKCategoryTypeIdentifierSleepAnalysis": "sleep",
    "HKWorkoutTypeIdentifier": "fitness",
    "HKCategoryTypeIdentifierAppleStandHour": "fitness",
    "HKCategoryTypeIdentifierMindfulSession": "health",
}
APPLE_UNITS = {
    "count": "steps", "mi": "miles", "km": "kilometers", "Cal": "calories",
    "kcal": "calories", "count/min": "bpm", "ms": "milliseconds",
    "mmHg": "mmHg", "mg/dL": "mg/dL", "lb": "pounds", "kg": "kilograms",
    "in": "inches", "cm": "centimeters", "%": "percent",
    "degF": "fahrenheit", "degC": "celsius",
}
APPLE_SUBTYPES = {
    "HKQuantityTypeIdentifierStepCount": "steps",
    "HKQuantityTypeIdentifierHeartRate": "heart_rate",
    "HKQuantityTypeIdentifierDistanceWalkingRunning": "distance",
    "HKQuantityTypeIdentifierActiveEnergyBurned": "calories",
    "HKQuantityTypeIdentifierBloodPressureSystolic": "blood_pressure",
    "HKQuantityTypeIdentifierBloodPressureDiastolic": "blood_pressure",
    "HKCategoryTypeIdentifierSleepAnalysis": "sleep_analysis",
}
# Record type -> metric name; every other mapped type stores "metric_value".
APPLE_METRIC_KEYS = {
    "HKQuantityTypeIdentifierStepCount": "steps",
    "HKQuantityTypeIdentifierDistanceWalkingRunning": "distance",
    "HKQuantityTypeIdentifierActiveEnergyBurned": "calories",
    "HKQuantityTypeIdentifierHeartRate": "heart_rate",
    "HKQuantityTypeIdentifierRestingHeartRate": "resting_heart_rate",
    "HKQuantityTypeIdentifierBloodPressureSystolic": "bp_systolic",
    "HKQuantityTypeIdentifierBloodPressureDiastolic": "bp_diastolic",
    "HKQuantityTypeIdentifierBodyMass": "weight",
}
APPLE_TYPE_PREFIX = "HKQuantityTypeIdentifier"

# Habit name keywords -> category, first match wins.
HABIT_CATEGORIES = [
    ("fitness", ["exercise", "workout", "run", "walk", "yoga", "stretch"]),
    ("nutrition", ["eat", "fruit", "vegetable", "water", "drink", "nutrition"]),
    ("sleep", ["sleep", "bed", "rest"]),
    ("mental_health", ["meditat", "mindful", "journal", "read", "study", "learn"]),
    ("health_monitoring", ["weigh", "measure", "track", "vitamin", "supplement"]),
    ("personal_care", ["brush", "floss", "shower", "skincare"]),
]

# Self-tracked CSV: file name keywords -> health type, first match wins.
MANUAL_TYPES = [
    ("migraine", ["migraine", "headache"]),
    ("symptoms", ["symptom"]),
    ("medication", ["medication", "drug"]),
    ("mood", ["mood", "mental"]),
    ("pain", ["pain"]),
    ("weight", ["weight", "bmi"]),
    ("blood_pressure", ["blood_pressure", "bp"]),
    ("glucose", ["glucose", "blood_sugar"]),
]
MANUAL_FILE_KEYWORDS = [
    "migraine", "symptom", "pain", "medication", "mood", "mental",
    "weight", "bmi", "blood_pressure", "bp", "glucose", "sugar",
    "manual", "health", "diary", "log", "track",
]
MANUAL_DATE_FIELDS = ["date", "Date", "timestamp", "time", "datetime", "when"]
MANUAL_FIELDS = {
    "symptom": ["symptom", "symptoms", "condition", "issue"],
    "symptom_severity": ["severity", "intensity", "level", "rating"],
    "symptom_duration": ["duration", "duration_hours", "duration_minutes"],
    "medication": ["medication", "drug", "medicine", "name"],
    "dosage": ["dosage", "dose", "amount", "mg", "ml"],
    "frequency": ["frequency", "times_per_day", "schedule"],
    "mood": ["mood", "feeling", "emotion", "state"],
    "mood_score": ["score", "rating", "level", "scale"],
    "pain_location": ["location", "area", "body_part"],
    "pain_intensity": ["intensity", "level", "rating", "pain_scale"],
    "weight": ["weight", "body_weight", "mass"],
    "bmi": ["bmi", "body_mass_index"],
    "systolic": ["systolic", "sys", "top_number"],
    "diastolic": ["diastolic", "dia", "bottom_number"],
    "glucose": ["glucose", "blood_glucose", "blood_sugar", "bg"],
}
SEVERITY_WORDS = {"L": "low", "M": "medium", "H": "high",
                  "low": "low", "medium": "medium", "high": "high"}
SEVERITY_SCORES = {"low": 2, "medium": 3, "high": 4}

# Sleep CSV: metric -> column aliases of the detailed format.
SLEEP_DETAILED_FIELDS = {
    "sleep_duration": ["sleep_duration", "duration", "total_sleep"],
    "sleep_efficiency": ["sleep_efficiency", "efficiency"],
    "deep_sleep": ["deep_sleep", "deep", "deep_sleep_minutes"],
    "light_sleep": ["light_sleep", "light", "light_sleep_minutes"],
    "rem_sleep": ["rem_sleep", "rem", "rem_sleep_minutes"],
    "awake_time": ["awake_time", "awake", "wake_time"],
    "wake_ups": ["wake_ups", "wakeups", "wake_count"],
    "time_to_sleep": ["time_to_sleep", "sleep_latency", "time_to_fall_asleep"],
}
SLEEP_DETAILED_TS = ["date", "Date", "timestamp", "bedtime", "sleep_start"]

# Movement app: file base name -> data type.
MOVES_FILE_TYPES = {"activities": "fitness", "places": "location",
                    "storyline": "location", "summary": "fitness"}
MILES_TO_METRES = 1609.34

# Wristband JSON defaults.
NIKE_DEFAULTS = {"activity_type": "ALL_DAY", "device_type": "FUELBAND",
                 "timezone": "America/Los_Angeles"}
NIKE_FILE_PATTERN = r"NikePlus-(\d{4}-\d{2}-\d{2})-([^-]+)"

# Expected metric names per data type (data-quality check).
EXPECTED_FIELDS = {
    "fitness": ["steps", "calories", "distance"],
    "health": ["heart_rate", "blood_pressure"],
    "sleep": ["sleep_duration", "sleep_start", "sleep_end"],
}
REQUIRED_FIELDS = ["id", "timestamp", "source", "data_type", "processed_at"]
QUALITY_GRADES = [(90, "excellent"), (80, "production_ready"),
                  (70, "needs_improvement"), (0, "not_production_ready")]
PROCESSOR_COUNT = 6

ARCHIVE_EXTENSIONS = ["zip", "gz", "tar", "tgz", "rar", "7z"]
