"""Frozen experiment settings and fixed values.

The numbers below must equal the published behaviour for results to match, so
they are kept together as plain literals.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values (must match the published behaviour) -------------------
START_DATE = "2024-01-01"
END_DATE = "2024-03-31"
SAMPLES_PER_CLASS = 500
PAGE_SIZE = 100
PAGES = 5
SEED = 53353
TRAIN_FRACTION = 0.70
CALIBRATION_FRACTION = 0.15
TARGET_ACCURACY = 0.90
MIN_INPUT_CHARS = 20
MAX_INPUT_CHARS = 6000
MIN_TEMPERATURE = 0.05
MAX_TEMPERATURE = 10.0
NLL_CLIP = 1e-12
TARGET_SLACK = 1e-12
ECE_BINS = 15
RELIABILITY_BINS = 10
BOOTSTRAP_RESAMPLES = 1000
BOOTSTRAP_CONFIDENCE = 0.95
REQUIRED_GAIN = 0.02
TOP_K = 3
WORD_MAX_FEATURES = 60000
CHAR_MAX_FEATURES = 60000
MIN_DF = 2
LOGISTIC_C = 4.0
LOGISTIC_MAX_ITER = 1000
# Spark's L-BFGS stops on the relative fall of the loss: 1e-4 leaves up to 1.3 % of
# the starting gradient, 1e-6 under 0.06 % (the reference's rule is on the gradient).
LOGISTIC_TOL = 1e-6

ROUTE_ACTION = "model_assisted_route"
REVIEW_ACTION = "human_review"
REASON_MEETS = "The calibrated confidence meets the frozen review threshold."
REASON_FAILS_CLOSED = (
    "The frozen calibration policy did not meet its target, so this item fails closed."
)
REASON_BAD_SCORES = "The scores are missing, incomplete or not finite, so this item fails closed."
REASON_BAD_MODEL = "The model's artifacts are missing or invalid, so this item fails closed."
REASON_BELOW = "The calibrated confidence is below the frozen review threshold."
ROUTE_HEADLINE_REVIEW = "HUMAN REVIEW REQUIRED"
ROUTE_HEADLINE_ROUTE = "MODEL-ASSISTED ROUTE CANDIDATE"
ROUTE_DETAIL_REVIEW = "Do not route this item automatically."
ROUTE_DETAIL_ROUTE = "Human confirmation is still required before any consequential action."
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class ExperimentConfig:
    start_date: str = START_DATE
    end_date: str = END_DATE
    samples_per_class: int = SAMPLES_PER_CLASS
    page_size: int = PAGE_SIZE
    pages: int = PAGES
    seed: int = SEED
    train_fraction: float = TRAIN_FRACTION
    calibration_fraction: float = CALIBRATION_FRACTION
    target_accuracy: float = TARGET_ACCURACY
    min_coverage: float = 0.0


# Temperature used by the registered routing checks on the lineitem fixture
# (the coarse-grid optimum at sf0.01/sf0.1); the fitted value comes from
# operators.calibrate.fit_temperature.
FIXTURE_TEMPERATURE = 0.9
