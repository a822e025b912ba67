"""Whole plans: replay of a workspace, state tables, and the registered queries."""
