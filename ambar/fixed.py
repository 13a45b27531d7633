"""Fixed values of the domain: names, edges and presets that results depend on."""

# --- Fixed values: feature lists -----------------------------------------------------------
LEVELS = [f"nivel_{i}" for i in range(9)]
AGGREGATE_FEATURES = [
    "media_portugues", "soma_niveis_basicos", "soma_niveis_avancados", "ano",
    *LEVELS,
    "codigo_uf", "rede",
]
PUPIL_FEATURES = ["presenca", "serie", "caderno", "rede", "ano"]
INDICATOR_FEATURES = ["taxa_alfabetizacao", "media_portugues", *LEVELS]
CLUSTER_FEATURES = ["taxa_alfabetizacao", "media_portugues", *LEVELS]

# --- Fixed values: columns known only after the outcome ------------------------------------
LEAKY_COLUMNS = ["proficiencia", "preenchimento_caderno", *INDICATOR_FEATURES]
ID_COLUMNS = ["id_registro", "id_aluno", "id_escola", "id_municipio", "sigla_uf"]

# --- Fixed values: target and bins ---------------------------------------------------------
TARGET_RATE = 80
ATTENDANCE_EDGES = [0, 0.5, 0.7, 0.85, 0.95, 1.0]
ATTENDANCE_LABELS = ["muito_baixa", "baixa", "media", "boa", "excelente"]
SCHOOL_SIZE_EDGES = [0, 50, 200, 500, 10000]
SCHOOL_SIZE_LABELS = ["pequena", "media", "grande", "muito_grande"]
RISK_EDGES = [0.30, 0.50, 0.70, 0.90]
RISK_LABELS = ["critico", "alto", "medio", "baixo", "minimo"]
CRITICAL_RISK = 0.30

# --- Fixed values: sampling ----------------------------------------------------------------
SEED = 42
EXPORT_FRACTIONS = {"features_ml": 0.10, "microdados_alunos": 0.01, "indicadores_municipio": 0.20, "metas_uf": 1.0}

# --- Fixed values: accuracy cut sweep, 0.30 to 0.69 in steps of 0.01 -----------------------
CUTS = [i / 100 for i in range(30, 70)]

# --- Fixed values: boosted-tree presets ----------------------------------------------------
# reg_alpha and reg_lambda have no counterpart in GBTClassifier; they are kept for the record.
PRESETS = {
    "agregado": {
        "n_estimators": 300, "learning_rate": 0.05, "max_depth": 6, "min_child_weight": 3, "subsample": 0.8,
        "colsample_bytree": 0.8, "gamma": 0.1, "reg_alpha": 0.1, "reg_lambda": 1.0, "seed": 42,
    },
    "individual": {
        "n_estimators": 50, "learning_rate": 0.1, "max_depth": 4, "min_child_weight": 2, "subsample": 0.8,
        "colsample_bytree": 0.8, "reg_alpha": 0.5, "reg_lambda": 2.0, "seed": 42,
    },
    "melhorado": {
        "n_estimators": 100, "learning_rate": 0.05, "max_depth": 5, "min_child_weight": 2, "subsample": 0.8,
        "colsample_bytree": 0.8, "reg_alpha": 0.3, "reg_lambda": 1.5, "seed": 42,
    },
    "controle_leakage": {
        "n_estimators": 20, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.7, "colsample_bytree": 0.7, "seed": 42,
    },
}

# --- Fixed values: random search space (30 draws, 3 folds, AUC) ----------------------------
SEARCH_SPACE = {
    "n_estimators": [50, 100, 150, 200],
    "max_depth": [3, 4, 5, 6, 7],
    "learning_rate": [0.01, 0.03, 0.05, 0.1],
    "min_child_weight": [1, 2, 3, 5],
    "subsample": [0.6, 0.7, 0.8, 0.9],
    "colsample_bytree": [0.6, 0.7, 0.8, 0.9],
    "reg_alpha": [0, 0.1, 0.3, 0.5, 1.0],
    "reg_lambda": [0.5, 1.0, 1.5, 2.0, 3.0],
}
SEARCH_DRAWS = 30
SEARCH_FOLDS = 3
CV_FOLDS = 5
