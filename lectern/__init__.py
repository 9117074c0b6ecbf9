"""A PySpark engine for multilingual content corpora."""
