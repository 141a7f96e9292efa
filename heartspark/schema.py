"""Fixed values of the survey data model.

Everything in the "fixed values" blocks below must equal the published survey
codebook and pipeline configuration for results to match; it is data, kept in
natural order, and every operator reads it from here.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Raw column name -> engine column name, in source file order.
# ---------------------------------------------------------------------------
RENAME = {
    "HeartDiseaseorAttack": "heart_disease",
    "HighBP": "high_bp",
    "HighChol": "high_chol",
    "CholCheck": "chol_check",
    "BMI": "bmi",
    "Smoker": "smoker",
    "Stroke": "stroke",
    "Diabetes": "diabetes",
    "PhysActivity": "phys_activity",
    "Fruits": "fruits",
    "Veggies": "veggies",
    "HvyAlcoholConsump": "hvy_alcohol",
    "AnyHealthcare": "any_healthcare",
    "NoDocbcCost": "no_doc_cost",
    "GenHlth": "gen_hlth",
    "MentHlth": "ment_hlth_days",
    "PhysHlth": "phys_hlth_days",
    "DiffWalk": "diff_walk",
    "Sex": "sex",
    "Age": "age_group",
    "Education": "education",
    "Income": "income",
}

TARGET = "heart_disease"
SOURCE_COLUMNS = list(RENAME.values())  # 22, file order

# Column groups of the ETL configuration.
BINARY = [
    "high_bp", "high_chol", "chol_check", "smoker", "stroke", "phys_activity",
    "fruits", "veggies", "hvy_alcohol", "any_healthcare", "no_doc_cost", "diff_walk",
]
ORDINAL = ["gen_hlth", "age_group", "education", "income"]
CATEGORICAL = ["sex", "diabetes"]
NUMERIC = ["bmi", "ment_hlth_days", "phys_hlth_days"]
INTEGER_COLUMNS = BINARY + ORDINAL + CATEGORICAL + [TARGET, "ment_hlth_days", "phys_hlth_days"]

# Codebook domains and bounds checked before loading.
DOMAINS = {
    **{c: [0, 1] for c in BINARY},
    "heart_disease": [0, 1],
    "sex": [0, 1],
    "diabetes": [0, 1, 2],
    "gen_hlth": [1, 2, 3, 4, 5],
    "age_group": list(range(1, 14)),
    "education": list(range(1, 7)),
    "income": list(range(1, 9)),
}
BOUNDS = {"bmi": (12, 98), "ment_hlth_days": (0, 30), "phys_hlth_days": (0, 30)}

# WHO BMI classes, (lower bound inclusive, upper bound exclusive, code).
BMI_CLASSES = [
    (0.0, 18.5, 1),
    (18.5, 25.0, 2),
    (25.0, 30.0, 3),
    (30.0, 35.0, 4),
    (35.0, 40.0, 5),
    (40.0, float("inf"), 6),
]

# Quality thresholds.
BMI_MIN_PLAUSIBLE = 14.0
BMI_MAX_PLAUSIBLE = 60.0
EXPECTED_ROWS = 253_680
EXPECTED_COLUMNS = 22
PREVALENCE_RANGE_PCT = (8.5, 10.5)
EXTREME_BMI_ALERT_PCT = 1.0
DAY_CAP = 30

# Analytical table layout (31 columns).
DERIVED = ["total_unhealthy_days", "risk_factor_count", "healthy_habits_count", "has_care_access"]
FLAGS = ["flag_bmi_extreme", "flag_profil_duplique", "flag_sante_incoherente"]
ANALYTICAL_COLUMNS = ["respondent_id"] + SOURCE_COLUMNS + ["bmi_class"] + DERIVED + FLAGS

# ---------------------------------------------------------------------------
# Dimension labels of the star schema (survey codebook).
# ---------------------------------------------------------------------------
LABELS_AGE = {
    1: "18-24 ans", 2: "25-29 ans", 3: "30-34 ans", 4: "35-39 ans", 5: "40-44 ans",
    6: "45-49 ans", 7: "50-54 ans", 8: "55-59 ans", 9: "60-64 ans", 10: "65-69 ans",
    11: "70-74 ans", 12: "75-79 ans", 13: "80 ans et plus",
}
LABELS_EDUCATION = {
    1: "Aucune scolarité", 2: "Primaire", 3: "Secondaire non achevé",
    4: "Secondaire achevé", 5: "Supérieur non achevé", 6: "Diplômé du supérieur",
}
LABELS_INCOME = {
    1: "Moins de 10 000 $", 2: "10 000 à 15 000 $", 3: "15 000 à 20 000 $",
    4: "20 000 à 25 000 $", 5: "25 000 à 35 000 $", 6: "35 000 à 50 000 $",
    7: "50 000 à 75 000 $", 8: "75 000 $ et plus",
}
LABELS_SEX = {0: "Femme", 1: "Homme"}
LABELS_GENHLTH = {1: "Excellente", 2: "Très bonne", 3: "Bonne", 4: "Moyenne", 5: "Mauvaise"}
LABELS_DIABETES = {0: "Non", 1: "Prédiabète", 2: "Diabète"}
LABELS_BMI_CLASS = {
    1: "Insuffisance pondérale", 2: "Corpulence normale", 3: "Surpoids",
    4: "Obésité modérée (I)", 5: "Obésité sévère (II)", 6: "Obésité morbide (III)",
}
UNKNOWN_KEY = -1
UNKNOWN_LABEL = "Inconnu"

# (table, key column, fact source column, label column, members)
DIMENSIONS = [
    ("dim_age", "age_key", "age_group", "tranche_age", LABELS_AGE),
    ("dim_education", "education_key", "education", "niveau_education", LABELS_EDUCATION),
    ("dim_income", "income_key", "income", "tranche_revenu", LABELS_INCOME),
    ("dim_sex", "sex_key", "sex", "sexe", LABELS_SEX),
    ("dim_genhlth", "genhlth_key", "gen_hlth", "sante_generale", LABELS_GENHLTH),
    ("dim_diabetes", "diabetes_key", "diabetes", "statut_diabete", LABELS_DIABETES),
    ("dim_bmi_class", "bmi_class_key", "bmi_class", "classe_imc", LABELS_BMI_CLASS),
]
DIM_BY_TABLE = {d[0]: d for d in DIMENSIONS}

# Fact table column order (31 columns).
FACT_COLUMNS = (
    ["respondent_id"] + [d[1] for d in DIMENSIONS]
    + ["bmi", "ment_hlth_days", "phys_hlth_days", "total_unhealthy_days"]
    + BINARY
    + ["risk_factor_count", "healthy_habits_count", "has_care_access"]
    + FLAGS + [TARGET]
)

# Status label of the report and short segment labels of the EDA.
STATUS_SICK = "Atteint"
STATUS_HEALTHY = "Non atteint"
SEGMENT_LABELS = {
    "age_group": {
        1: "18-24", 2: "25-29", 3: "30-34", 4: "35-39", 5: "40-44", 6: "45-49",
        7: "50-54", 8: "55-59", 9: "60-64", 10: "65-69", 11: "70-74",
        12: "75-79", 13: "80+",
    },
    "gen_hlth": {1: "Excellente", 2: "Très bonne", 3: "Bonne", 4: "Moyenne", 5: "Mauvaise"},
    "bmi_class": {
        1: "Insuff. pond.", 2: "Normale", 3: "Surpoids",
        4: "Obésité I", 5: "Obésité II", 6: "Obésité III",
    },
    "income": {
        1: "<10k", 2: "10-15k", 3: "15-20k", 4: "20-25k",
        5: "25-35k", 6: "35-50k", 7: "50-75k", 8: "75k+",
    },
    "education": {
        1: "Aucune", 2: "Primaire", 3: "Sec. non ach.",
        4: "Secondaire", 5: "Sup. non ach.", 6: "Diplômé sup.",
    },
    "diabetes": {0: "Non", 1: "Prédiabète", 2: "Diabète"},
    "sex": {0: "Femme", 1: "Homme"},
}
SEGMENTS = ["age_group", "gen_hlth", "bmi_class", "income", "education", "diabetes"]

# ---------------------------------------------------------------------------
# Model feature order (3 continuous, 5 ordinal, 13 binary).
# ---------------------------------------------------------------------------
FEATURES_CONTINUOUS = ["bmi", "ment_hlth_days", "phys_hlth_days"]
FEATURES_ORDINAL = ["gen_hlth", "age_group", "education", "income", "diabetes"]
FEATURES_BINARY = [
    "high_bp", "high_chol", "chol_check", "smoker", "stroke", "phys_activity",
    "fruits", "veggies", "hvy_alcohol", "any_healthcare", "no_doc_cost",
    "diff_walk", "sex",
]
FEATURES = FEATURES_CONTINUOUS + FEATURES_ORDINAL + FEATURES_BINARY
SEED = 42
TEST_SHARE = 0.20
N_FOLDS = 5
TARGET_RECALL = 0.75

# Reference prevalence and risk presentation rules.
REFERENCE_PREVALENCE = 0.0942
RISK_BAND_EDGES = [0.0, 0.05, 0.10, 0.20, 0.40, 1.0]  # right-closed, 0 excluded
RISK_BAND_LABELS = ["< 5 %", "5-10 %", "10-20 %", "20-40 %", "> 40 %"]
RISK_LEVELS = [(0.5, "Faible"), (1.5, "Proche de la moyenne"), (3.0, "Élevé")]
RISK_LEVEL_TOP = "Très élevé"
PEER_DEAD_BAND = 0.005
MIN_PEERS = 30

# Scorecard used as a deterministic risk for the scoring oracle.
SCORECARD_POINTS = {
    "age_group": 4, "gen_hlth": 5, "high_bp": 8, "high_chol": 6, "smoker": 4,
    "stroke": 12, "diff_walk": 5, "diabetes": 3, "sex": 5,
}
SCORECARD_DIVISOR = 20000.0

# Display names of the model variables (unknown names show as themselves).
VARIABLE_NAMES = {
    "bmi": "Indice de masse corporelle",
    "ment_hlth_days": "Jours de mal-être mental",
    "phys_hlth_days": "Jours de mal-être physique",
    "gen_hlth": "État de santé perçu",
    "age_group": "Tranche d'âge",
    "education": "Niveau d'études",
    "income": "Revenu du foyer",
    "diabetes": "Diabète",
    "high_bp": "Hypertension",
    "high_chol": "Cholestérol élevé",
    "chol_check": "Dosage du cholestérol",
    "smoker": "Tabagisme",
    "stroke": "Antécédent d'AVC",
    "phys_activity": "Activité physique",
    "fruits": "Consommation de fruits",
    "veggies": "Consommation de légumes",
    "hvy_alcohol": "Consommation d'alcool excessive",
    "any_healthcare": "Couverture santé",
    "no_doc_cost": "Renoncement aux soins (coût)",
    "diff_walk": "Difficulté à marcher",
    "sex": "Sexe",
}

# Fixed value: published decision threshold of the deployed model.
DECISION_THRESHOLD = 0.12684148102998732
