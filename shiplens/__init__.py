"""Deployment-risk analytics on Spark: contract, features, models, score history, evidence."""
