"""Anomaly, position and congestion models, their evaluation and the record of runs."""
