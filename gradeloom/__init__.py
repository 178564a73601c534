"""Learner activity analytics as Spark DataFrame jobs."""
