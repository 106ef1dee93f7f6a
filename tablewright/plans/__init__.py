"""Composed flows."""

from tablewright.plans.enrichment import (
    PageRates,
    PageSources,
    age_bands,
    enrich,
    enrich_from_pages,
    group_bands,
    rates_from_pages,
    youth_band,
)
from tablewright.plans.preparation import (
    CLINICAL_RULES,
    CLINICAL_STATISTICAL,
    Prepared,
    RulesConfig,
    StatisticalConfig,
    prepare_rules,
    prepare_statistical,
)
from tablewright.plans.selection import Candidate, Selection, select_model

__all__ = [
    "CLINICAL_RULES", "CLINICAL_STATISTICAL", "Candidate", "PageRates", "PageSources", "Prepared",
    "RulesConfig", "Selection", "StatisticalConfig", "age_bands", "enrich", "enrich_from_pages",
    "group_bands", "prepare_rules", "prepare_statistical", "rates_from_pages", "select_model",
    "youth_band",
]
