"""Operators that prepare training text: deduplication, classifiers, decontamination,
mixing and token files. Nothing else in the library imports this subpackage."""
