"""Data quality, classification and drift monitoring on Spark DataFrames."""

from .operators.boosting import BoostedOneVsRest, BoostedOneVsRestModel
from .operators.clean import impute_mean, remove_outliers_iqr
from .operators.drift import (
    drift,
    drift_summary,
    js_positional,
    ks_statistic,
    reference_profile,
    severity,
    top_drift,
    with_severity,
)
from .operators.evaluate import (
    alert_summary,
    compare_metrics,
    compare_predictions,
    confusion,
    degradation,
    metrics,
    pair_counts,
    performance_alert,
    report,
)
from .operators.features import (
    PopulationScaler,
    PopulationScalerModel,
    SignedPCA,
    decode_labels,
    encode_labels,
    preprocessing,
    standard_scale,
)
from .operators.perturb import (
    add_noise,
    add_shifted_noise,
    drop_values,
    perturbed_sample,
    relative_noise,
    scale_noise,
    shift,
)
from .operators.profile import (
    boxplot_outliers,
    boxplot_stats,
    category_counts,
    correlation,
    histogram,
    kde_curve,
    missing_percentage,
    missing_total,
    quantile_table,
    stats_categorical,
    stats_numeric,
)
from .operators.runs import (
    append_run,
    append_runs,
    best_per_group,
    best_run,
    compare_runs,
    fingerprint,
    read_runs,
    search_runs,
)
from .operators.score import score, validate_features
from .operators.split import (
    random_split,
    sample_n,
    stratified_folds,
    stratified_split,
    train_valid_test,
)
from .operators.train import gbt_one_vs_rest, random_forest, run_grid, tune
from .sources.tables import dataset_info, head_n, read_table, report_json, write_table
from .streaming.scoring import score_stream

__version__ = "0.1.0"
