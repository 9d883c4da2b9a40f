"""Environment-wide association scan: one logistic model per exposure,
outcome and model spec, all fitted together by distributed reweighted least
squares over aggregated covariate patterns."""
