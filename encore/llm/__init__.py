"""Operators for preparing training text: cleaning, tokens, classifiers, duplicates,
decontamination, scoring and licences. Nothing else in the library imports this package."""
