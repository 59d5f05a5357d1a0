"""End-to-end plans: the pipeline, searches and reports."""

from linfold.plans.pipeline import Pipeline  # noqa: F401
