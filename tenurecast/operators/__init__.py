"""Table-level steps: casts, profiles, categories, imputation, models."""
