"""Column expressions, including the chi-square p-value."""

from .exprs import *  # noqa: F401,F403
from .stats import chi2_sf  # noqa: F401
