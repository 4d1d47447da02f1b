"""Queries over the given tables, each with an independent SQL twin where SQL can say it."""

from __future__ import annotations


def all_checks():
    from checks import q_bank, q_clean, q_files, q_places, q_site, q_sources, q_state  # noqa: F401
    from checks.registry import QUERIES, TWINS

    return dict(QUERIES), dict(TWINS)
