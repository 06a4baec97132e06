"""Parameters of the clean → trim → scale → cluster → report job.

One frozen dataclass per stage, passed explicitly to the operators, so no
value is repeated as a literal at the call sites.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must equal the reference for the same results) -----------
# Descriptive columns of the cleaned catalogue table, in output order.
PRODUCT_DESCRIPTIVE_COLUMNS = (
    "_id", "product_name", "brands", "categories", "nutriscore_grade", "nova_group",
)
# The nine measures per 100 g, in output order.
PRODUCT_MEASURE_COLUMNS = (
    "energy_100g", "proteins_100g", "carbohydrates_100g", "sugars_100g",
    "fat_100g", "saturated-fat_100g", "fiber_100g", "salt_100g", "sodium_100g",
)
# Name of the struct holding the measures in the nested JSON export.
PRODUCT_MEASURE_STRUCT = "nutriments"
# Header renames of the delimited export (only `code` changes).
PRODUCT_DELIMITED_RENAMES = {"code": "_id"}
# Minimum number of valid measures for a row to be kept.
MIN_VALID_MEASURES = 5
# Outlier trim: lower/upper probabilities and the quantile relative error.
TRIM_PROBABILITIES = (0.02, 0.98)
TRIM_RELATIVE_ERROR = 0.01
# K-means: sweep k = 2..15 with maxIter 50; final fit maxIter 200, tol 1e-6,
# initSteps 10; seed 42 everywhere; a chosen k of 3 or less becomes 4.
SWEEP_MIN_K = 2
SWEEP_MAX_K = 15
SWEEP_MAX_ITER = 50
FINAL_MAX_ITER = 200
FINAL_TOL = 1e-6
FINAL_INIT_STEPS = 10
KMEANS_SEED = 42
CHOSEN_K_FLOOR = 3
CHOSEN_K_REPLACEMENT = 4
# PCA projection size.
PCA_COMPONENTS = 2
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class CleanConfig:
    """Row-validity filter and imputation (ingest stage)."""

    measure_cols: tuple[str, ...] = PRODUCT_MEASURE_COLUMNS
    descriptive_cols: tuple[str, ...] = PRODUCT_DESCRIPTIVE_COLUMNS
    # Type of the descriptive columns; None keeps the type of present ones.
    descriptive_type: str | None = "string"
    min_valid: int = MIN_VALID_MEASURES
    impute_value: float = 0.0


@dataclass(frozen=True)
class TrimConfig:
    """Sequential per-feature quantile trim."""

    probabilities: tuple[float, float] = TRIM_PROBABILITIES
    relative_error: float = TRIM_RELATIVE_ERROR


@dataclass(frozen=True)
class SweepConfig:
    min_k: int = SWEEP_MIN_K
    max_k: int = SWEEP_MAX_K
    max_iter: int = SWEEP_MAX_ITER
    seed: int = KMEANS_SEED
    # Fits run concurrently; results do not depend on it.
    parallelism: int = 4
    # Convergence tolerance of the sweep fits (MLlib's default).
    tol: float = 1e-4


@dataclass(frozen=True)
class FitConfig:
    max_iter: int = FINAL_MAX_ITER
    tol: float = FINAL_TOL
    init_steps: int = FINAL_INIT_STEPS
    seed: int = KMEANS_SEED


@dataclass(frozen=True)
class ChooseConfig:
    floor: int = CHOSEN_K_FLOOR
    replacement: int = CHOSEN_K_REPLACEMENT


@dataclass(frozen=True)
class JobConfig:
    feature_cols: tuple[str, ...] = PRODUCT_MEASURE_COLUMNS
    clean: CleanConfig = field(default_factory=CleanConfig)
    trim: TrimConfig = field(default_factory=TrimConfig)
    sweep: SweepConfig = field(default_factory=SweepConfig)
    fit: FitConfig = field(default_factory=FitConfig)
    choose: ChooseConfig = field(default_factory=ChooseConfig)
    pca_components: int = PCA_COMPONENTS
    # Partitions of the vectors that K-means passes over (its result depends on
    # the layout, so this is a parameter, not a guess from size or machine).
    partitions: int = 200
    # Rows of the ordered preview.
    preview_rows: int = 20
    # Path of the saved model; None keeps it in memory only.
    model_path: str | None = None
    # Folder of the run journal, which lets a rerun go on where one ended; None keeps none.
    journal_path: str | None = None
