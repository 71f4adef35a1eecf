"""Ticket reporting on Spark: DataFrame operators and report plans for service-desk data."""

from triagegrid.session import build_session

__all__ = ["build_session"]
