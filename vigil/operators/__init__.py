"""DataFrame -> DataFrame operators.  No operator triggers an action, except those that
write an intermediate table once (``ordered.running_totals`` and what stands on it, ``clinical.dose_summary``) and model fitting.

Modules: ``cohort`` (state blocks, first qualifying block, demographics), ``temporal``
(window join, as-of join, first row per key, next row time), ``reshape`` (EAV pivot,
window features, worst values, densify, filters), ``ordered`` (prefix sums, exact
quantiles), ``evaluate`` (score ladder and the evaluation tables), ``bootstrap``,
``clinical`` (doses, ventilation, organ score), ``profile`` (describe, missingness,
histograms, Table 1), ``sites`` (multi-site comparison), ``model`` (Spark ML pipeline).
"""
