"""The layered plan: staging, cleaning, gold, features, metrics, analyses, reports."""
