"""DataFrame-to-DataFrame operators of the cohort and exposure stages."""
