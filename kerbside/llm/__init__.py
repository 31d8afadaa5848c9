"""Operators of a training-data pipeline: text tables in, decisions and cleaned tables out."""
