"""Operators of a training-data pipeline: decontamination, scoring, dedup, scans and packing.

Nothing outside this folder imports it. ``queries`` lists the ready-made queries.
"""
