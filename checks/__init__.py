"""Every operator as a query on the test tables, with the SQL that must agree with it."""

from checks import searches, tables, texts, vectors  # noqa: F401
from checks.registry import ORACLES, QUERIES

QUERIES_AND_ORACLES = (QUERIES, ORACLES)
