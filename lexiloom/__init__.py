"""lexiloom: a PySpark-native engine for preparing language-model corpora."""

__version__ = "0.1.0"
