"""Whole jobs: staging, the nightly run, the dashboard and the registered queries."""
