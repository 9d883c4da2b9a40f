"""Whole-study plans: the staged run, the quality report, result exploration."""
