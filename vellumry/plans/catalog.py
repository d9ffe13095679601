"""Imports every module that registers queries."""

from vellumry.plans import links, redaction, search, sessions, site, tables, tree  # noqa: F401
