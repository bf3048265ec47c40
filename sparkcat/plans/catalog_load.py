"""Imports all query modules, so that their queries are registered."""

from . import catalogue, filters_joins, groups_windows, texts_streams  # noqa: F401
