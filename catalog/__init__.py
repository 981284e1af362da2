"""Registered queries over the given tables, each with its SQL counterpart."""

from catalog import events, identity, news, pages, runs, scores, stored  # noqa: F401
from catalog.registry import QUERIES, Tables  # noqa: F401
