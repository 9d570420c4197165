"""Data-quality expectations, per-day figures, quarantine, alert rate and drift."""
