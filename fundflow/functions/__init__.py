"""Column expressions: exact sums and deviations, signed amounts, returns, row rules."""

from fundflow.functions.exact import add_up, exact_mean, exact_sum, mean_of, minus, settle
from fundflow.functions.measures import daily_return, inflow, outflow, signed_amount
from fundflow.functions.moments import add_moments, billionths, moments, sample_deviation
from fundflow.functions.rules import domain, positive, required

__all__ = [
    "add_moments",
    "add_up",
    "billionths",
    "daily_return",
    "domain",
    "exact_mean",
    "exact_sum",
    "inflow",
    "mean_of",
    "minus",
    "moments",
    "outflow",
    "positive",
    "required",
    "sample_deviation",
    "settle",
    "signed_amount",
]
