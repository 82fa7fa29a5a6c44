"""Queries over the test tables, each with its plain SQL where SQL can say it."""

from counterfold.catalog import data, effects, models, runs

QUERIES = {**data.QUERIES, **models.QUERIES, **effects.QUERIES, **runs.QUERIES}
ORACLE = {**data.ORACLE, **models.ORACLE, **effects.ORACLE, **runs.ORACLE}
