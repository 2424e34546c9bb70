"""The core's query modules."""

from __future__ import annotations

from . import analytics, coverage, problems

MODULES = (problems, analytics, coverage)


def flagship(spark, sf_dir):
    return analytics.representatives_topn(spark, sf_dir)
