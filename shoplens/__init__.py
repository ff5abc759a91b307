"""shoplens: e-commerce behaviour and ad-click analytics as Spark DataFrame plans.

Batch requirements take DataFrames and return DataFrames (no actions inside);
streaming wiring lives in :mod:`shoplens.streaming`.
"""

from shoplens.params import ActionFilter, AdsParams, PageFlow, SampleParams

__all__ = ["ActionFilter", "AdsParams", "PageFlow", "SampleParams"]
