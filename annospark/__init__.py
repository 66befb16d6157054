"""annospark: Spark jobs that turn a labelled corpus into a validated fine-tuning dataset."""
