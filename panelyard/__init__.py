"""Panels, features and reports from raw item feeds, on Spark."""

from panelyard.spec import CollectSpec, ItemColumns, Layers, PanelSpec, SpecError

__all__ = ["CollectSpec", "ItemColumns", "Layers", "PanelSpec", "SpecError"]
