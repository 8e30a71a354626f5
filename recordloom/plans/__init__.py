"""Declared plans: saved reports and derived fields of a whole dataset."""
