"""Registered queries: each has a Spark plan and, where SQL can say it, its SQL."""
