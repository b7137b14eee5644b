"""Reconciling declared event timelines with observed ones, as Spark jobs."""
