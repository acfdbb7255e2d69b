"""domus: a Spark-native engine for modelling prices over a monthly listing panel.

Sub-packages:

- ``sources``   — snapshot CSV loading, the panel view over the shared test tables,
                  table store, panel upsert, prediction/version logs.
- ``functions`` — column-expression helpers (text, geo, maps, statistics).
- ``operators`` — DataFrame operators: contract rules, exact ranks and splits,
                  imputation, metrics, conformal intervals, drift, location,
                  registry, promotion, scoring, monitoring.
- ``plans``     — multi-operator flows (training, drift jobs) and the query catalog.
- ``streaming`` — Structured Streaming scoring and outcome metrics.
"""

__version__ = "0.1.0"
