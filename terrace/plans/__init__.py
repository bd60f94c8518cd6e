"""The six subject areas as bronze -> silver -> gold jobs built from library operators.

Each module exposes ``bronze``, ``silver`` and ``gold`` (one Spark job group each) and
``run`` (all layers in dependency order). Column names keep the source vocabulary:
that is the data model the gold tables are queried by.
"""

from terrace.plans import admissions, beds, currency, deaths, health_plans, rail
from terrace.plans.common import Layout

AREAS = {
    "rail": rail,
    "currency": currency,
    "admissions": admissions,
    "beds": beds,
    "deaths": deaths,
    "health_plans": health_plans,
}

__all__ = ["AREAS", "Layout", "admissions", "beds", "currency", "deaths", "health_plans", "rail"]
