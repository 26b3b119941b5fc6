"""sentimart: review ingestion, text cleaning, lexicon sentiment, data quality and analytics
marts as PySpark DataFrame jobs."""

__version__ = "0.1.0"
