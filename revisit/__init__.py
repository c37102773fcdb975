"""Appointment and retention analytics as Spark DataFrame operators."""

from revisit.config import Settings

__all__ = ["Settings"]
