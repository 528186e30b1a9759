"""Spark-first analytics for annotated genomes, gene families and sampled gene histories."""
