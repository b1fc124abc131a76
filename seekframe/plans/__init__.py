"""Pipelines composed of operators: hybrid search, prompts, message logs."""
