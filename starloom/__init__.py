"""starloom: a product-usage event warehouse on Spark DataFrames.

Layers: raw JSON events -> typed staging -> star schema (users, documents,
features, dates; event and user-day facts) -> cohort retention, feature
adoption and churn views, reports and quality checks.
"""

__version__ = "0.1.0"
