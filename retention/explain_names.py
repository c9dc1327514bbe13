"""Naming of attribution columns, shared by the linear and tree explainers."""

PREFIX = "shap_"


def shap_name(feature: str) -> str:
    return PREFIX + feature
