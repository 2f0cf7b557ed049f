"""Headway: transit schedule and traffic analytics as Spark DataFrame operators."""
