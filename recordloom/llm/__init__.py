"""Operators that prepare training data: language, archives, decontamination, secrets, mixing,
neighbours, URL rules, chat formats, near duplicates and toxicity.

Nothing else in the library imports this package.
"""
