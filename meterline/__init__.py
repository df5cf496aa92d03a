"""Meterline: trip-table preparation, boosted trees and parameter search as Spark jobs."""

__version__ = "0.1.0"
