"""Episodic-event analytics as Spark DataFrame operators."""
