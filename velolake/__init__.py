"""Bike-share analytics as Spark jobs: batch marts, live status and quality gates."""
