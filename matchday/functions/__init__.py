"""Column-level formulas (Column -> Column)."""
from .cols import *  # noqa: F401,F403
from .cols import (age_bucket, age_description, age_text, classify, clean_sheet, clip_null, consensus, decode, devig2,
                   devig3, first_pair, is_first, num, num_or, parse_ts, poisson_lambda_ge3, poisson_lambda_ge3_jvm, ratio_or,
                   season_code, season_short, split_goals, stable_bucket, tier, weighted_flags)
