"""Data jobs: dimensions, facts, views, gold tables and the runs that chain them."""
