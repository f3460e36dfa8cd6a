"""The runnable queries. Importing this package registers all of them."""

from attesta.plans import q_corpus, q_marts, q_org, q_stream, q_text, q_verdicts  # noqa: F401
from attesta.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
