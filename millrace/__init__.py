"""millrace: DataFrame operators that turn code-hosting activity into curated, scored datasets."""

__version__ = "0.1.0"
