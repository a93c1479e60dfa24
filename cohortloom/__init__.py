"""Cohort event reports on Spark: code-set selection, enrichment, ranking, eligibility."""

from cohortloom.spec import CodeSet, FlagRule, ReportSpec, Run, Section, Switches, TextSet

__all__ = ["CodeSet", "FlagRule", "ReportSpec", "Run", "Section", "Switches", "TextSet"]
