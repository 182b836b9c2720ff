"""Training-data operators: ten methods for corpora of documents and pages."""
