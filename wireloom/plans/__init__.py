"""Whole jobs: collect, enrich, publish, backfill; and the registered queries."""
