"""curatrix: curation and evaluation of labelled text corpora on Apache Spark."""
