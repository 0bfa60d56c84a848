"""Layered-table toolkit: raw files -> bronze -> quality report -> silver / quarantine -> gold.

Everything is a function from DataFrames to DataFrames; only the writers in ``sources`` and
``plans.run`` start jobs. One ``DatasetSpec`` says what is particular to a dataset.
"""

from tierwork.spec import INCIDENTS, DatasetSpec

__all__ = ["INCIDENTS", "DatasetSpec"]
