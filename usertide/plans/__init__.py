"""The jobs: cleaning, audits, features, cohorts, models, scoring, evaluation and segments."""
