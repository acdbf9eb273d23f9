"""Composed jobs: feeds to bronze, bronze to silver, silver to answers and models."""
